import random
import zlib

import numpy as np

from millrace.llm import byte_language as b
from millrace.llm import convnet

SOUNDS = {"en": "the ing tion er and of ly".split(), "fr": "eau ou de la é tre que".split(), "de": "sch ein ung der ß ver ich".split()}


def corpus(n=300, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(list(SOUNDS))
        text = " ".join("".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(5, 120)))
        rows.append((i, text, lang))
    return rows


def test_held_out_accuracy_and_odd_texts(make_docs):
    docs = corpus()
    odd = [(1000, None, "en"), (1001, "", "fr"), (1002, "123 !? 45", None), (1003, "sch ein ung " * 20_000, None), (1004, "é", None), (None, "the of", None),
           (1005, "²", None), (1006, "①½ Ⅷ ٣", None), (1007, "ª", None)]
    rows = b.identify(make_docs(docs + odd + [docs[0]], ["cuts", "codes"])).collect()
    assert len(rows) == len(docs) + len(odd) + 1
    found = {r["doc_id"]: r for r in rows}
    for i, _, lang in docs:
        assert found[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= found[i]["score"] <= 1
    held = [found[i]["lang_pred"] == lang for i, _, lang in docs if found[i]["held_out"]]
    assert np.mean(held) > 0.95
    assert [found[i]["lang_pred"] for i in (1000, 1001, 1002, 1003)] == ["und", "und", "und", "de"] and found[1000]["score"] == 0
    assert found[1004]["lang_pred"] in SOUNDS and found[1007]["lang_pred"] in SOUNDS
    assert [(found[i]["lang_pred"], found[i]["score"]) for i in (1005, 1006)] == [("und", 0.0)] * 2


def test_nothing_labelled_and_empty(make_docs):
    assert [r["lang_pred"] for r in b.identify(make_docs([(1, "the"), (2, None)])).collect()] == ["und", "und"]
    assert b.identify(make_docs([])).collect() == []
    one = b.identify(make_docs([(i, "the of and", "en") for i in range(20)])).collect()
    assert {r["lang_pred"] for r in one} == {"en"}


def test_labels_and_held_out_texts_do_not_reach_predictions(make_docs):
    docs = corpus(120)
    hidden = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 5 == 0 else lang) for i, t, lang in docs]
    one = {r["doc_id"]: r["lang_pred"] for r in b.identify(make_docs(docs)).collect()}
    other = {r["doc_id"]: r["lang_pred"] for r in b.identify(make_docs(hidden)).collect()}
    assert one == other and "xx" not in other.values()


def test_windows_cover_every_byte():
    rng = np.random.default_rng(0)
    sizes = [0, 1, 127, 128, 129, 1000, 0]
    data = rng.integers(1, 255, sum(sizes)).astype(np.uint8)
    starts = np.r_[0, np.cumsum(sizes)]
    codes, first = b.window_codes(data, starts, 128)
    for i, n in enumerate(sizes):
        own = codes[first[i]:first[i + 1]].ravel()
        assert own[:n].tolist() == data[starts[i]:starts[i + 1]].tolist() and not own[n:].any()


def test_gradients():
    """Training lowers the loss of a task that only the order of bytes decides."""
    rng = np.random.default_rng(3)
    codes = rng.integers(1, 5, (400, 20)).astype(np.uint8)
    labels = np.array([int(any(row[i] == 1 and row[i + 1] == 2 and row[i + 2] == 3 for i in range(18))) for row in codes])
    net = convnet.train(codes, labels, 2, epochs=30)
    assert (net.logits(codes).argmax(1) == labels).mean() > 0.95


def test_known_keeps_clean_rows(make_docs):
    docs = corpus(80)
    df = make_docs(docs + [(900, "12345", None), (901, None, None)])
    kept = b.known(df)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == {d[0] for d in docs}


def test_the_draw_does_not_depend_on_the_layout(make_docs):
    """A hot id with many texts, more of them than are drawn."""
    docs = [(7 if i % 2 else i, f"{t} {i}", lang) for i, t, lang in corpus(400)]
    codes, labels, names = b.training_windows(make_docs(docs), sample=40)
    again = b.training_windows(make_docs(docs[::-1]).repartition(7), sample=40)
    assert (codes == again[0]).all() and (labels == again[1]).all() and names == again[2] and len(names) == 3
