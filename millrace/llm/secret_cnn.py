"""Secret scans: fixed patterns, and a character network over every other candidate in its context."""

from __future__ import annotations

import pickle
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import convnet
from millrace.llm.common import (
    batches_of, bytes_of, map_texts, materialize, numbered, row_chunks, set_apart, split_text, text_rows, with_lanes)

# The base patterns, their order, and the least lengths (of group 2, the match, the match).
ASSIGN = re.compile(rb"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
KINDS = ["assign", "access", "hex", "model"]
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24

CANDIDATE_LEAST = 16  # bytes of an unbroken run that the network looks at,
MIXED_LEAST = 8       # or of one with both letters and digits
CONTEXT = 24          # bytes on either side
SPAN = 48             # bytes of the candidate that a window holds; a longer one has several windows
WINDOW = 2 * CONTEXT + SPAN
SHARD = 4000          # windows of each label that a pass of the fit holds; all shards take part in it
TASKS = 32            # that read shards, and send a sum to the driver
SHARDS_PER_BATCH = 4  # that a worker holds
STEPS, FAR = 256, 32  # steps of margins by one, and the largest
MARGINS = np.arange(-FAR * STEPS, FAR * STEPS + 1) / STEPS
RECALL = 0.98         # of known secrets, with and without their keyword, held out from the fit
CHUNK = 1 << 22
FOUND = "kinds array<int>, starts array<int>, ends array<int>, cuts array<binary>"


def table_of(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[np.frombuffer(chars, np.uint8)] = True
    return table


LOWER, UPPER, DIGITS = b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789"
HEX_BYTES = table_of(DIGITS + b"abcdef")
RUN_BYTES = table_of(LOWER + UPPER + DIGITS + b"+/_=-")
LETTER_BYTES, DIGIT_BYTES = table_of(LOWER + UPPER), table_of(DIGITS)


def long_runs(member: np.ndarray, least: int, starts: np.ndarray) -> list[tuple[int, int, int]]:
    """(row, start, end) of maximal runs of at least ``least`` bytes inside rows."""
    full, size = member, 1
    while size < least:  # full[i]: the next ``size`` bytes all belong
        step = min(size, least - size)
        if len(full) <= step:
            return []
        full, size = full[:-step] & full[step:], size + step
    edge = np.diff(np.r_[0, full.view(np.int8), 0])
    out = []
    for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
        b += least - 1
        row = int(np.searchsorted(starts, a, "right")) - 1
        while a < b:  # a run may go on over the end of a row
            stop = min(b, int(starts[row + 1]))
            if stop - a >= least:
                out.append((row, a, stop))
            a, row = stop, row + 1
    return out


def candidate_runs(data: np.ndarray, starts: np.ndarray) -> list[tuple[int, int, int]]:
    """(row, start, end) of the maximal runs inside rows that the network looks at."""
    member = RUN_BYTES[data]
    heads = np.zeros(len(data) + 1, bool)
    heads[starts] = True
    before = np.r_[False, member[:-1]] if len(member) else member
    first = np.flatnonzero(member & (~before | heads[:-1]))
    last = np.flatnonzero(member & ~np.r_[member[1:], False] | member & heads[1:]) + 1
    size = last - first
    long = size >= MIXED_LEAST
    first, last, size = first[long], last[long], size[long]

    def holds(table: np.ndarray) -> np.ndarray:
        sums = np.r_[0, np.cumsum(table[data])]
        return sums[last] > sums[first]

    good = (size >= CANDIDATE_LEAST) | holds(LETTER_BYTES) & holds(DIGIT_BYTES)
    first, last = first[good], last[good]
    return list(zip((np.searchsorted(starts, first, "right") - 1).tolist(), first.tolist(), last.tolist()))


def base_spans(data: np.ndarray, starts: np.ndarray) -> list[list[tuple[int, int, int, int]]]:
    """For each row (start, kind, end, start of the secret itself) of the fixed patterns, in bytes from the row's start, in
    order."""
    found: list[list[tuple[int, int, int, int]]] = [[] for _ in range(len(starts) - 1)]
    assigns = (data == ord("=")) | (data == ord(":"))
    signs = np.unique(np.searchsorted(starts, np.flatnonzero(assigns), "right") - 1)
    for row in signs.tolist():
        for m in ASSIGN.finditer(data[starts[row]:starts[row + 1]].tobytes()):
            if m.end(2) - m.start(2) >= ASSIGN_LEAST:
                found[row].append((m.start(), 0, m.end(), m.start(2)))
    keys = (data[:-3] == ord("A")) & (data[1:-2] == ord("K")) & (data[2:-1] == ord("I")) & (data[3:] == ord("A"))
    for row in np.unique(np.searchsorted(starts, np.flatnonzero(keys), "right") - 1).tolist():
        for m in ACCESS.finditer(data[starts[row]:starts[row + 1]].tobytes()):
            if m.end() - m.start() >= ACCESS_LEAST:
                found[row].append((m.start(), 1, m.end(), m.start()))
    for row, a, b in long_runs(HEX_BYTES[data], HEX_LEAST, starts):
        found[row].append((int(a - starts[row]), 2, int(b - starts[row]), int(a - starts[row])))
    for spans in found:
        spans.sort()
    return found


def plain(part: bytes) -> bytes:
    return bytes(c if c < 128 else 1 for c in part)


def window_of(row: bytes, a: int, b: int, context: int | None = None) -> bytes:
    """Context, candidate and context as codes: ASCII stands for itself in the context and is moved up by 128
    in the candidate, other bytes are 1; missing bytes are 0. The left context ends at ``context``, or where the candidate
    begins."""
    before = a if context is None else context
    left, right = plain(row[max(0, before - CONTEXT):before]), plain(row[b:b + CONTEXT])
    return left.rjust(CONTEXT, b"\0") + bytes(128 + c % 128 for c in row[a:b]).ljust(SPAN, b"\0") + right.ljust(CONTEXT, b"\0")


def windows_of(row: bytes, a: int, b: int) -> bytes:
    """Windows over a whole candidate, one after another; the last one ends with it."""
    if b - a <= SPAN:
        return window_of(row, a, b)
    return b"".join(window_of(row, s, s + SPAN) for s in dict.fromkeys([*range(a, b - SPAN, SPAN), b - SPAN]))


def scan_rows(data: np.ndarray, starts: np.ndarray):
    """For each row its spans in code points, base spans first by order, then the other candidates, each with
    its windows. A candidate that touches a base span is left to it. An assigned secret has one more window, of the
    secret by itself where its keyword stands, so that secrets are known without one."""
    base = base_spans(data, starts)
    runs: dict[int, list[tuple[int, int]]] = {}
    for row, a, b in candidate_runs(data, starts):
        runs.setdefault(row, []).append((int(a - starts[row]), int(b - starts[row])))
    for row, spans in enumerate(base):
        if not spans and row not in runs:
            yield [], [], [], []
            continue
        text = data[starts[row]:starts[row + 1]]
        raw = text.tobytes()
        taken = np.zeros(len(text) + 1, np.int64)
        for a, _, b, _ in spans:
            taken[a] += 1
            taken[b] -= 1
        covered = np.r_[0, np.cumsum(np.cumsum(taken[:-1]) > 0)]
        free = [(a, 3, b, a) for a, b in runs.get(row, []) if covered[b] == covered[a]]
        points = np.r_[0, np.cumsum((text & 0xC0) != 0x80)]  # code points before each byte
        every = [*spans, *free]
        yield ([k for _, k, _, _ in every], [int(points[a]) for a, _, _, _ in every], [int(points[b]) for _, _, b, _ in every],
               [windows_of(raw, a, b) + (window_of(raw, s, min(b, s + SPAN), a) if s > a else b"") for a, _, b, s in every])


def findings(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns of ``keep``, and kinds (0 to 2 base patterns, 3 undecided), starts, ends, cuts of each row."""
    def run(batches):
        for batch in batches:
            text, carried, kept = split_text(batch)
            data, starts = bytes_of(text)
            found = []
            for a, b in row_chunks(starts, CHUNK):
                found += scan_rows(data[starts[a]:starts[b]], starts[a:b + 1] - starts[a])
            columns = list(zip(*found)) or [()] * 4
            kinds = [pa.list_(pa.int32())] * 3 + [pa.list_(pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [*carried, *(pa.array(c, k) for c, k in zip(columns, kinds))], [*kept, "kinds", "starts", "ends", "cuts"])

    rows, schema = text_rows(docs, keep)
    return map_texts(rows, run, f"{schema}, {FOUND}")


def labelled(found: DataFrame) -> DataFrame:
    """label and cut: spans of the base patterns are findings (1), other candidates, by their first window, are not known
    to be (0): the others of a long candidate have no context, and would teach that nothing without context is one. Each different window
    of a label once, whatever their number."""
    each = found.select(F.explode(F.arrays_zip("kinds", "cuts")).alias("x")).select(
        F.when(F.col("x.kinds") < 3, 1).otherwise(0).alias("label"), F.col("x.cuts").alias("cuts"))
    return each.select("label", F.explode(F.expr(
        f"transform(sequence(0, if(label = 1, cast(length(cuts) / {WINDOW} as int) - 1, 0)), i -> substring(cuts, i * {WINDOW} + 1, {WINDOW}))")).alias("cut")).distinct()


def dealt(each: DataFrame, size: int = SHARD) -> DataFrame | None:
    """All windows of ``labelled`` in shards of about ``size`` of the more frequent label: a row per shard with its cuts (hex, end
    to end), labels and turns. Turns number the windows of both labels and are the same in every shard. Windows of the
    rarer label stand in as many shards as make the labels equal there, at most in all of them; None if a label is missing."""
    rows = materialize(with_lanes(each.withColumn("h", F.xxhash64("cut"))), "windows")
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return None
    most = max(counts.values())
    shards = -(-most // size)
    copies = F.when(F.col("label") == 0, min(shards, most // counts[0])).otherwise(min(shards, most // counts[1]))
    turned = numbered(rows, [counts[0], counts[1]], "label", ["h", "cut"], "turn")
    turned = turned.withColumn("turn", F.col("turn") + F.col("label") * counts[0])
    # Ten turns go together, so that every shard has its share of each split by turns.
    spread = turned.withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1))).withColumn(
        "shard", F.pmod(F.floor(F.col("turn") / 10) + F.col("copy"), F.lit(shards)))
    whole = spread.groupBy("shard").agg(
        F.array_sort(F.collect_list(F.struct("turn", "label", "cut"))).alias("x"))
    return materialize(whole.select("shard", F.array_join(F.transform("x", lambda x: F.hex(x["cut"])), "").alias("cuts"),
                                    F.col("x.label").alias("labels"), F.col("x.turn").alias("turns")), "shards")


def over_shards(shards: DataFrame):
    """A function that adds up, over all shards, the arrays that a task makes of windows, labels and turns.

    It maps batches, as all text operators do, for a task on an RDD has Python workers and a daemon of its own, which stay
    beside theirs."""
    def over(task):
        def run(batches):
            total = None
            for batch in batches:
                for cuts, labels, turns in zip(*(batch.column(c) for c in ("cuts", "labels", "turns"))):
                    windows = np.frombuffer(bytes.fromhex(cuts.as_py()), np.uint8).reshape(-1, WINDOW)
                    part = task(windows, *(x.values.to_numpy().astype(np.int64) for x in (labels, turns)))
                    total = part if total is None else [a + b for a, b in zip(total, part)]
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(total)], pa.binary())], ["total"])

        # One sum per task comes to the driver, in order, so that rounding is the same each time.
        with batches_of(shards.sparkSession, SHARDS_PER_BATCH):
            totals = shards.coalesce(TASKS).mapInArrow(run, "total binary").collect()
        return [sum(x) for x in zip(*(pickle.loads(r["total"]) for r in totals))]

    return over


def margin(net: convnet.ConvNet, windows: np.ndarray) -> np.ndarray:
    """Log odds of a finding before calibration, in steps of 1 / STEPS, so that those of all windows can be counted."""
    scores = net.logits(windows).astype(np.float64)
    return np.clip(np.floor((scores[:, 1] - scores[:, 0]) * STEPS), -FAR * STEPS, FAR * STEPS) / STEPS


def margin_counts(net: convnet.ConvNet, windows: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """How many windows of each label have each margin of MARGINS."""
    place = np.round(margin(net, windows) * STEPS).astype(np.int64) + FAR * STEPS
    return np.stack([np.bincount(place[labels == k], minlength=len(MARGINS)) for k in (0, 1)])


def calibrate(counts: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and intercept of a logistic curve from margin to probability, by damped Newton steps."""
    slope, shift = 1.0, 0.0
    some = np.flatnonzero(counts.any(0))
    margins, counts = MARGINS[some], counts[:, some].astype(float)
    others, secrets = counts.sum(1)
    n = counts.sum(0)
    goal = counts[1] * (secrets + 1) / (secrets + 2) + counts[0] / (others + 2)
    x = np.stack([margins, np.ones_like(margins)], 1)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + shift, -50, 50)))
        w = n * (p * (1 - p) + 1e-6)
        move = np.linalg.solve((x * w[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (goal - n * p) - 1e-3 * np.array([slope, shift]))
        slope, shift = slope + 0.5 * move[0], shift + 0.5 * move[1]
    return float(slope), float(shift)


def chance_of(margins: np.ndarray, slope: float, shift: float) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(slope * margins + shift, -50, 50)))


def chances(net: convnet.ConvNet, slope: float, shift: float, windows: np.ndarray) -> np.ndarray:
    return chance_of(margin(net, windows), slope, shift)


def trained(over, chosen, epochs: int = 6) -> convnet.ConvNet:
    """A network fitted to the windows that ``chosen`` picks from all shards. Each pass starts from the same state in all
    of them, and their states after it are averaged by windows."""
    state = convnet.start(2, each=16)
    for number in range(epochs):
        def task(windows, labels, turns, state=state, number=number):
            use = chosen(windows, labels, turns)
            order = np.random.default_rng([convnet.SEED, number]).permutation(use.sum())
            after = convnet.epoch(state, windows[use], labels[use], order, batch=32)
            return [use.sum(), *(use.sum() * x.astype(np.float64) for x in after)]

        n, *sums = over(task)
        state = [(total / n).astype(x.dtype) for total, x in zip(sums, state)]
    return convnet.net_of(state)


def calibrated(over, net: convnet.ConvNet, chosen) -> tuple[np.ndarray, float, float]:
    """Counts of margins of the windows that ``chosen`` picks, slope and intercept."""
    def task(windows, labels, turns):
        use = chosen(windows, labels, turns)
        return [margin_counts(net, windows[use], labels[use])]

    counts, = over(task)
    return counts, *calibrate(counts)


def label_counts(over, *picks) -> list[np.ndarray]:
    """The number of windows of each label that each of ``picks`` picks."""
    return over(lambda windows, labels, turns: [np.bincount(labels[pick(windows, labels, turns)], minlength=2) for pick in picks])


def fit_over(over, recall: float):
    """(network, slope, intercept, threshold) from all windows of all shards; see ``fit``."""
    def half(k):
        return lambda windows, labels, turns: turns // 5 % 2 == k

    judges = []  # (half that is judged, network fitted to the other half, slope, intercept)
    sizes = label_counts(over, half(0), half(1))
    for k in (0, 1):
        if sizes[k].min() > 1 and sizes[1 - k].any():
            net = trained(over, half(k))
            judges.append((half(1 - k), net, *calibrated(over, net, half(k))[1:]))

    def sure(windows, labels, turns):
        keep = np.ones(len(labels), bool)
        for judged, *judge in judges:
            ask = judged(windows, labels, turns) & (labels == 0)
            keep[ask] = chances(*judge, windows[ask]) < 0.5
        return keep

    def every(windows, labels, turns):
        return np.ones(len(labels), bool)

    if not label_counts(over, sure)[0][0]:
        sure = every

    def held(windows, labels, turns):
        return sure(windows, labels, turns) & (turns % 5 == 0)

    def taught(windows, labels, turns):
        return sure(windows, labels, turns) & (turns % 5 != 0)

    if min(x.min() for x in label_counts(over, held, taught)) == 0:
        held = taught = sure
    net = trained(over, taught)
    counts, slope, shift = calibrated(over, net, held)
    least = np.searchsorted(np.cumsum(counts[1]), int((1 - recall) * counts[1].sum()), "right")
    return net, slope, shift, float(chance_of(MARGINS[least], slope, shift))


def fit(windows: np.ndarray, labels: np.ndarray, recall: float = RECALL):
    """(network, slope, intercept, threshold), or None where one of the two labels is missing.

    Two networks are fitted to one half of the windows each and asked about the other half: what they take for secrets
    there, though no pattern says so, may well be some, and teaches the last network nothing. A fifth of the windows is held
    out from that one. Of its probabilities that keep ``recall`` of the secrets held out, the highest is the threshold.
    """
    if len(np.unique(labels)) < 2:
        return None
    turns = np.arange(len(labels))
    return fit_over(lambda task: task(windows, labels, turns), recall)


def fit_all(found: DataFrame, recall: float, size: int = SHARD):
    """``fit`` to all windows of a table of findings, shard by shard in tasks."""
    shards = dealt(labelled(found), size)
    return None if shards is None else fit_over(over_shards(shards), recall)


def decided(batch: pa.RecordBatch, model) -> list[list[tuple[int, int, int]]]:
    """For each row of a batch of findings its (start, kind, end) in order, without the candidates that the network turns down."""
    kinds, starts, ends, cuts = (batch.column(n).to_pylist() for n in ("kinds", "starts", "ends", "cuts"))
    ask = [(i, j) for i, ks in enumerate(kinds) for j, k in enumerate(ks) if k == 3]
    taken = set()
    if ask and model is not None:
        net, slope, shift, threshold = model
        sizes = np.array([len(cuts[i][j]) // WINDOW for i, j in ask])
        for first, last in row_chunks(np.r_[0, np.cumsum(sizes)], 4096):
            some = ask[first:last]
            windows = np.frombuffer(b"".join(cuts[i][j] for i, j in some), np.uint8).reshape(-1, WINDOW)
            heads = np.cumsum(sizes[first:last]) - sizes[first:last]
            # A candidate is what its most suspicious window is.
            best = np.maximum.reduceat(chances(net, slope, shift, windows), heads)
            taken.update(x for x, c in zip(some, best) if c >= threshold)
    return [sorted((s, k, e) for j, (k, s, e) in enumerate(zip(ks, ss, es)) if k < 3 or (i, j) in taken)
            for i, (ks, ss, es) in enumerate(zip(kinds, starts, ends))]


def decide(found: DataFrame, model) -> DataFrame:
    """Drop the candidates that the network turns down, and the windows."""
    def run(batches):
        for batch in batches:
            names, spans = batch.schema.names, decided(batch, model)
            out = [pa.array([[x[c] for x in row] for row in spans], pa.list_(pa.int32())) for c in (1, 0, 2)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-4], *out], [*names[:-4], "kinds", "starts", "ends"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema[:-4]]
    return map_texts(found, run, ", ".join([*fields, "kinds array<int>, starts array<int>, ends array<int>"]))


def searched(docs: DataFrame, keep: list[str], shard: int = SHARD, recall: float = RECALL):
    """Stored findings, and the model fitted to all of them."""
    clash = {"kinds", "starts", "ends", "cuts", "text_to_read"} & set(keep)
    if clash:
        raise ValueError(f"columns named like results: {sorted(clash)}")
    found = materialize(findings(docs, keep), "findings")
    return found, fit_all(found, recall, shard)


def scan(docs: DataFrame, keep: list[str] | None = None, shard: int = SHARD, recall: float = RECALL) -> DataFrame:
    """Find secrets in every whole text.

    Returns the columns of ``keep`` (doc_id by default) and three arrays in order of start, then kind: kinds
    (positions in KINDS), starts, ends, in code points, ends exclusive. The kinds of the fixed patterns are
    always there. ``model`` spans are runs of 16 or more letters, digits and ``+/_=-`` outside them, or of 8 or more with
    both letters and digits, to which the network, trained on this corpus with the fixed patterns as labels, gives in some
    window a probability of at least a threshold that keeps ``recall`` of known secrets held out. It learns from all findings
    and candidates of the corpus, in shards of about ``shard`` windows of a label. Without any known secret, or without any other candidate, there is nothing to learn from and only the patterns are reported.

    Null and empty texts have empty arrays; texts of any length are read whole; repeated rows each get their
    row; columns named like results are refused in ``keep``; an empty table gives an empty one.
    """
    return decide(*searched(docs, ["doc_id"] if keep is None else keep, shard, recall))


def redact(docs: DataFrame, mask: str = "[secret]", **options) -> DataFrame:
    """The same rows and columns, every found span of ``text`` replaced by ``mask`` and, where there is a column
    n_chars, its value made to fit. Overlapping spans become one mask; null stays null. ``options`` are those of ``scan``,
    whose spans these are; they are decided on and masked in one pass, so that a task has one Python worker."""
    plain = set_apart(docs, "doc_id", "text", "n_chars")
    names = plain.columns
    found, model = searched(plain, names, **options)

    def run(batches):
        for batch in batches:
            at = {n: i for i, n in enumerate(batch.schema.names)}
            columns = list(batch.columns[:len(names)])
            texts = columns[at["text"]].to_pylist()
            sizes = columns[at["n_chars"]].to_pylist() if "n_chars" in at else None
            for i, spans in enumerate(decided(batch, model)):
                if not spans:
                    continue
                parts, done, reach = [], 0, -1
                for a, _, b in spans:
                    if a >= reach:
                        parts += [texts[i][done:a], mask]
                    reach = done = max(reach, b)
                texts[i] = "".join(parts) + texts[i][done:]
                if sizes:
                    sizes[i] = len(texts[i])
            columns[at["text"]] = pa.array(texts, pa.string())
            if sizes is not None:
                columns[at["n_chars"]] = pa.array(sizes, columns[at["n_chars"]].type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return map_texts(found, run, plain.schema).toDF(*docs.columns)


def report(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds and of ``model``, base_sha256, spans as text."""
    found = scan(docs)
    kinds = F.array(*[F.lit(k) for k in KINDS])

    def count(k: int):
        return F.size(F.filter("kinds", lambda x: x == k)).cast("long")

    # Spans are in order already; arrays index from 1 with element_at.
    rows = F.arrays_zip("kinds", "starts", "ends")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(
            ":", F.element_at(kinds, x["kinds"] + 1), x["starts"].cast("string"), x["ends"].cast("string"))), ",")

    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), count(3).alias("n_model"),
        F.sha2(joined(F.filter(rows, lambda x: x["kinds"] < 3)).cast("binary"), 256).alias("base_sha256"),
        joined(rows).alias("spans"))
