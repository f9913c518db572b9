"""Language identification by a byte convolutional network over windows of whole texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import convnet
from millrace.llm.common import bytes_of, crc_of_id, map_texts, row_chunks, set_apart, split_text, text_rows

WINDOW = 128
SAMPLE = 6000  # expected number of labelled documents the network is fitted to
WINDOWS = 4    # windows that each of them gives
HELD_OUT = 5
CHUNK = 1 << 20
UNKNOWN = "und"


def training_windows(docs: DataFrame, sample: int = SAMPLE, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Windows, class numbers and class names from a hashed sample of the labelled documents outside the
    held-out fold. Each document gives ``WINDOWS`` windows, from places spread over its whole text."""
    open_fold = docs.where((crc_of_id() % HELD_OUT != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    there = open_fold.count()
    if not there:
        return np.zeros((0, window), np.uint8), np.zeros(0, np.int64), []
    buckets = 1 << 30
    share = min(buckets, buckets * sample // there + 1)
    raw = F.col("text").cast("binary")
    # Window starts lie anywhere in the text, the last one so that the window still fits.
    room = F.greatest(F.length(raw) - window, F.lit(0)) + 1
    cuts = [F.substring(raw, F.pmod(F.xxhash64("doc_id", F.lit(k)), room).cast("int") + 1, F.lit(window)) for k in range(WINDOWS)]
    # Drawn and put in order by text, so that a hot id brings some of its rows, and the same ones again.
    place = F.xxhash64(F.lit("sample"), "doc_id", "text")
    drawn = open_fold.where(F.pmod(place, F.lit(buckets)) < share)
    rows = drawn.select("lang", F.array(*cuts).alias("cuts"), place.alias("place")).orderBy("place", "lang").limit(2 * sample).collect()
    names = sorted({r["lang"] for r in rows})
    cuts, labels = [], []
    for r in sorted(rows, key=lambda r: (r["lang"], r["cuts"])):
        for cut in {bytes(c) for c in r["cuts"]}:
            if cut:
                cuts.append(cut)
                labels.append(names.index(r["lang"]))
    order = sorted(range(len(cuts)), key=lambda i: (cuts[i], labels[i]))
    codes = np.zeros((len(cuts), window), np.uint8)
    for j, i in enumerate(order):
        codes[j, :len(cuts[i])] = np.frombuffer(cuts[i], np.uint8)
    return codes, np.array([labels[i] for i in order], np.int64), names


def has_letter(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Whether each row holds a letter: an ASCII letter, or else one of the Unicode categories of letters, which numerals
    and digits of any kind are not in."""
    ascii_letter = ((data | 0x20) >= ord("a")) & ((data | 0x20) <= ord("z"))
    sums = np.r_[0, np.cumsum(ascii_letter)]
    found = sums[starts[1:]] > sums[starts[:-1]]
    for i in np.flatnonzero(~found):
        text = data[starts[i]:starts[i + 1]].tobytes().decode("utf-8", "replace")
        found[i] = any(map(str.isalpha, text))
    return found


def window_codes(data: np.ndarray, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """All bytes as windows of fixed length, each row beginning a new one, and each row's first window."""
    sizes = np.diff(starts)
    first = np.r_[0, np.cumsum(-(-sizes // window))]
    codes = np.zeros(int(first[-1]) * window, np.uint8)
    codes[np.arange(len(data)) + np.repeat(first[:-1] * window - starts[:-1], sizes)] = data
    return codes.reshape(-1, window), first


def predict(net: convnet.ConvNet, names: list[str], data: np.ndarray, starts: np.ndarray, window: int):
    """Class name and probability for each row of bytes: the class whose log probability is largest over all
    windows, and its mean probability."""
    n = len(starts) - 1
    label, score = np.full(n, UNKNOWN, object), np.zeros(n)
    letters = has_letter(data, starts)
    for a, b in row_chunks(starts, CHUNK):
        codes, first = window_codes(data[starts[a]:starts[b]], starts[a:b + 1] - starts[a], window)
        rows = np.flatnonzero(letters[a:b])
        if not len(rows):
            continue
        # Long rows run window by window; their sums are kept by row.
        chance = convnet.softmax(net.logits(codes).astype(np.float64))
        heads = first[rows]
        # Rows without letters lie between the heads; their windows must not count.
        own = np.zeros(len(codes), bool)
        for r in rows:
            own[first[r]:first[r + 1]] = True
        logs = np.add.reduceat(np.where(own[:, None], np.log(chance + 1e-9), 0), heads, axis=0)
        sums = np.add.reduceat(np.where(own[:, None], chance, 0), heads, axis=0)
        best = logs.argmax(1)
        label[a + rows] = np.array(names, object)[best]
        score[a + rows] = sums[np.arange(len(rows)), best] / (first[rows + 1] - first[rows])
    return label, np.clip(score, 0, 1)


def identify(docs: DataFrame, train_on: DataFrame | None = None, keep: list[str] | None = None, sample: int = SAMPLE,
             window: int = WINDOW) -> DataFrame:
    """Predict the language of every whole text.

    The network learns from text and non-null lang of about ``sample`` documents of ``train_on`` (the same
    documents by default) whose crc32(doc_id) mod 5 is not 0; lang, source and doc_id are no inputs of a
    prediction. Returns the columns of ``keep`` (doc_id by default), held_out, lang_pred, score (0 to 1).

    Null and empty texts, and those without a letter, get ``und`` with score 0, and so do all texts if
    nothing is labelled. Texts of any length are read whole, window by window. Repeated rows each get their
    row; a column of ``keep`` named like a result is refused; an empty table gives an empty one.
    """
    keep = ["doc_id"] if keep is None else keep
    codes, labels, names = training_windows(docs if train_on is None else train_on, sample, window)
    net = convnet.train(codes, labels, len(names)) if len(codes) else None

    def run(batches):
        for batch in batches:
            text, columns, kept = split_text(batch)
            data, starts = bytes_of(text)
            if net is None:
                label, score = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            else:
                label, score = predict(net, names, data, starts, window)
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(label, pa.string()), pa.array(score)], [*kept, "lang_pred", "score"])

    clash = {"held_out", "lang_pred", "score", "text_to_read"} & set(keep)
    if clash:
        raise ValueError(f"columns named like results: {sorted(clash)}")
    rows, schema = text_rows(docs, keep, (crc_of_id() % HELD_OUT == 0).alias("held_out"))
    return map_texts(rows, run, f"{schema}, lang_pred string, score double")


def known(docs: DataFrame, least: float = 0.3, **options) -> DataFrame:
    """The rows of ``docs`` whose language is known with a score of at least ``least``, all columns kept. With the
    four languages of the sample tables, 0.25 would be no better than a guess."""
    plain = set_apart(docs, "doc_id", "text", "lang")
    found = identify(plain, keep=plain.columns, **options)
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select(*plain.columns).toDF(*docs.columns)
