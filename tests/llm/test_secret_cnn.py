import hashlib
import random
import re

import numpy as np

from millrace.llm import secret_cnn as s

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


def joined(spans):
    return ",".join(f"{s.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def corpus():
    rng = random.Random(2)
    out = []
    for i in range(200):
        text = " ".join("".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 20))) for _ in range(30))
        secret = "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice([20, 23, 24, 40])))
        extra = [f"Password = '{secret}'", f"AKIA{secret.upper()}", secret, f"TOKEN:{secret[:5]}", "4111111111111111", f"api_key=\"{secret}", ""][i % 7]
        at = rng.randint(0, len(text))
        out.append((i, text[:at] + " " + extra + " " + text[at:]))
    return out


def test_base_against_brute_force(make_docs):
    odd = [(900, None), (901, ""), (902, "ſecret=abcdefgh Kapi_key=abcdefgh"), (903, "token=token=abcdef"), (904, "a" * 24 + "é" + "0" * 24),
           (905, "password=" + "x" * 100_000), (906, "AKIAAKIA" + "A" * 30), (907, "0" * 23 + "\0" + "f" * 30)]
    docs = corpus() + odd
    rows = {r["doc_id"]: r for r in s.report(make_docs(docs, ["kinds", "cuts", "label"])).collect()}
    for i, text in docs:
        spans, r = base(text), rows[i]
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(k == j for _, k, _ in spans) for j in range(3))
        assert r["base_sha256"] == hashlib.sha256(joined(spans).encode()).hexdigest()
        every = r["spans"].split(",") if r["spans"] else []
        assert [x for x in every if not x.startswith("model")] == joined(spans).split(",") * bool(spans)
        assert len(every) == len(spans) + r["n_model"]


def test_spans_do_not_leak_over_rows():
    texts = [b"abc" * 5 + b"0" * 20, b"0" * 20, b"", b"f" * 30]
    data = np.frombuffer(b"".join(texts), np.uint8)
    starts = np.r_[0, np.cumsum([len(t) for t in texts])]
    assert s.long_runs(s.HEX_BYTES[data], 24, starts) == [(0, 0, 35), (3, 55, 85)]


def test_the_network_adds_findings_and_spares_others():
    rng = np.random.default_rng(4)

    def window(text):
        return np.frombuffer(s.window_of(b"see the " + text + b" and so on", 8, 8 + len(text)), np.uint8)

    secrets = [window(bytes(rng.choice(list(b"0123456789abcdef"), 32).tolist())) for _ in range(300)]
    words = [window(bytes(rng.choice(list(b"aeioutrnsl"), 18).tolist())) for _ in range(300)]
    net, slope, shift, threshold = s.fit(np.array(secrets + words), np.array([1] * 300 + [0] * 300))
    chance = 1 / (1 + np.exp(-(slope * s.margin(net, np.array(secrets + words)) + shift)))
    assert (chance[:300] >= threshold).mean() >= 0.99 and (chance[300:] >= threshold).mean() <= 0.01
    assert s.fit(np.array(words), np.zeros(300, int)) is None


def test_redaction(make_docs):
    docs = [(1, "é password=abcdefgh and AKIA" + "A" * 20), (2, None), (3, "clean"), (3, "clean"), (4, "token=" + "0" * 30)]
    df = make_docs(docs)
    found = s.redact(df)
    assert found.columns == df.columns
    rows = sorted((r["doc_id"], r["text"], r["n_chars"]) for r in found.collect() if r["doc_id"] != 2)
    assert rows == [(1, "é [secret] and [secret]", 23), (3, "clean", 5), (3, "clean", 5), (4, "[secret]", 8)]
    assert found.where("doc_id = 2").first()["text"] is None and s.redact(make_docs([])).collect() == []


def test_the_threshold_keeps_the_recall_whatever_it_is():
    """Secrets and others that look alike: no floor lifts the threshold above what keeps the secrets."""
    rng = np.random.default_rng(6)

    def window(alphabet):
        return np.frombuffer(s.window_of(bytes(rng.choice(list(alphabet), 20).tolist()), 0, 20), np.uint8)

    alike = np.array([window(b"abcdef") for _ in range(900)])
    labels = np.r_[np.ones(300, int), np.zeros(600, int)]
    net, slope, shift, threshold = s.fit(alike, labels, recall=0.9)
    held = np.arange(900) % 5 == 0
    assert threshold < 0.5 and (s.chances(net, slope, shift, alike[held & (labels == 1)]) >= threshold).mean() >= 0.9


def test_candidates_against_brute_force():
    rng = random.Random(9)
    texts = ["".join(rng.choice("abXY01-_ é.=") * rng.choice([1, 1, 2, 9]) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    raw = [t.encode() for t in texts]
    starts = np.r_[0, np.cumsum([len(x) for x in raw])]
    expected = []
    for i, x in enumerate(raw):
        for m in re.finditer(rb"[A-Za-z0-9+/_=-]+", x):
            if len(m[0]) >= 16 or len(m[0]) >= 8 and re.search(rb"[A-Za-z]", m[0]) and re.search(rb"[0-9]", m[0]):
                expected.append((i, int(starts[i]) + m.start(), int(starts[i]) + m.end()))
    assert s.candidate_runs(np.frombuffer(b"".join(raw), np.uint8), starts) == expected and len(expected) > 100
    assert s.candidate_runs(np.zeros(0, np.uint8), np.zeros(1, np.int64)) == []


def test_windows_cover_long_candidates():
    row = b"see " + bytes(range(65, 91)) * 5 + b" end"
    windows = s.windows_of(row, 4, 134)
    parts = [windows[i:i + s.WINDOW] for i in range(0, len(windows), s.WINDOW)]
    assert [bytes(c - 128 for c in w[s.CONTEXT:s.CONTEXT + s.SPAN]) for w in parts] == [row[4:52], row[52:100], row[86:134]]
    assert parts[0][:s.CONTEXT].strip(b"\0") == b"see " and parts[-1].endswith(b" end".ljust(s.CONTEXT, b"\0"))


def test_planted_secrets_without_a_keyword(make_docs):
    """Random values like those assigned elsewhere, short, long and very long, with nothing that names them; long words, long
    numbers and dates are no secrets."""
    rng = random.Random(12)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"

    def value(n):
        return "".join(rng.choice(alphabet) for _ in range(n))

    def prose(n):
        return " ".join("".join(rng.choice("aeioutrnslmd") for _ in range(rng.randint(2, 22))) for _ in range(n))

    docs, planted = [], {}
    for i in range(600):
        left, right = prose(12), prose(12)
        kind = i % 4
        if kind == 0:
            middle = f"{rng.choice(['password', 'token', 'api_key'])} = {value(rng.randint(12, 40))}"
        elif kind == 1 and i < 200:
            middle = value(rng.choice([12, 24, 40, 300]))
            planted[i] = (len(left) + 1, len(left) + 1 + len(middle))
        else:
            middle = rng.choice(["2024-01-31T10-20", "1234567890123456789", "well-known_words-and-more", "chapter-12-page-7"])
        docs.append((i, f"{left} {middle} {right}"))
    rows = {r["doc_id"]: r for r in s.report(make_docs(docs)).collect()}
    found = [f"model:{a}:{b}" in rows[i]["spans"].split(",") for i, (a, b) in planted.items()]
    assert np.mean(found) >= 0.75
    others = [rows[i]["n_model"] for i, _ in docs if i not in planted and i % 4]
    assert np.mean(np.array(others) > 0) <= 0.05, np.mean(np.array(others) > 0)


def shard_findings(spark, secrets, words):
    rows = [(i, [2], [0], [1], [c]) for i, c in enumerate(secrets)] + [(i, [3, 3], [0, 0], [1, 1], [c, c]) for i, c in enumerate(words)]
    return spark.createDataFrame(rows, f"doc_id long, {s.FOUND}")


def shard_windows(rng, alphabet, size, n):
    return [s.window_of(b"see the " + bytes(rng.choice(list(alphabet), size).tolist()) + b" and so on", 8, 8 + size) for _ in range(n)]


def test_the_network_learns_from_every_window(spark):
    """Each window of both labels is in a shard, whatever their number; the rarer label in as many as make the labels equal."""
    rng = np.random.default_rng(3)
    secrets, words = shard_windows(rng, b"0123456789abcdef", 32, 90), shard_windows(rng, b"aeioutrnsl", 18, 700)
    long = s.windows_of(b"x" * 100, 0, 100)
    seen = {}
    for r in s.dealt(s.labelled(shard_findings(spark, secrets, [*words, long])), 100).collect():
        cuts = bytes.fromhex(r["cuts"])
        assert sorted(r["turns"]) == r["turns"] and len(cuts) == s.WINDOW * len(r["labels"]) and 70 <= r["labels"].count(0) <= 110
        for i, (label, turn) in enumerate(zip(r["labels"], r["turns"])):
            seen.setdefault((label, cuts[i * s.WINDOW:(i + 1) * s.WINDOW]), []).append((turn, r["shard"]))
    expected = {(1, c) for c in secrets} | {(0, c) for c in words} | {(0, long[:s.WINDOW])}
    assert set(seen) == expected
    assert sorted(x[0][0] for x in seen.values()) == list(range(len(expected))) and all(len({t for t, _ in x}) == 1 for x in seen.values())
    assert all(len(x) == len(set(x)) == (7 if label else 1) for (label, _), x in seen.items())


def test_shards_make_one_network(spark):
    """A fit to many shards knows secrets from words; a fit to one is that to its windows at once."""
    rng = np.random.default_rng(5)
    secrets, words = shard_windows(rng, b"0123456789abcdef", 32, 120), shard_windows(rng, b"aeioutrnsl", 18, 900)
    found = shard_findings(spark, secrets, words)
    windows = np.array([np.frombuffer(c, np.uint8) for c in secrets + words])
    net, *rest, threshold = s.fit_all(found, s.RECALL, 150)
    chance = s.chances(net, *rest, windows)
    assert (chance[:120] >= threshold).mean() >= 0.95 and (chance[120:] >= threshold).mean() <= 0.01
    whole, = s.dealt(s.labelled(found), 2000).collect()
    windows = np.frombuffer(bytes.fromhex(whole["cuts"]), np.uint8).reshape(-1, s.WINDOW)
    assert s.fit_all(found, s.RECALL, 2000)[1:] == s.fit(windows, np.array(whole["labels"]))[1:]
    assert s.fit_all(shard_findings(spark, [], words), s.RECALL) is None


def test_one_python_worker_for_each_task(spark, make_docs):
    """Masking follows the decision in the same worker, and the fit runs in those of the other text operators."""
    import os

    import pyarrow as pa

    plan = s.redact(make_docs([(1, "password = abc123xyz"), (2, "word2word 2024-01-31T10-20")]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1

    def run(batches):
        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([os.getppid()])], ["daemon"])

    rng = np.random.default_rng(7)
    found = shard_findings(spark, shard_windows(rng, b"0123456789abcdef", 32, 5), shard_windows(rng, b"aeioutrnsl", 18, 5))
    shards = s.dealt(s.labelled(found))
    daemon, = s.over_shards(shards)(lambda windows, labels, turns: [np.array([os.getppid()])])
    assert shards.count() == 1 and [r["daemon"] for r in spark.range(0, 1, 1, 1).mapInArrow(run, "daemon long").collect()] == daemon.tolist()


def test_sums_of_shards_in_order(spark):
    """Sums over shards are those of their rows, whatever their number, and batches have their size again afterwards."""
    rng = np.random.default_rng(9)
    found = shard_findings(spark, shard_windows(rng, b"0123456789abcdef", 32, 40), shard_windows(rng, b"aeioutrnsl", 18, 300))
    shards = s.dealt(s.labelled(found), 20)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    codes, counts, turns = s.over_shards(shards)(lambda windows, labels, turns: [
        windows.sum(0, dtype=np.int64), np.bincount(labels, minlength=2), turns.sum()])
    rows = shards.collect()
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before and len(rows) > 10
    assert (codes == sum(np.frombuffer(bytes.fromhex(r["cuts"]), np.uint8).reshape(-1, s.WINDOW).sum(0, dtype=np.int64) for r in rows)).all()
    assert counts.tolist() == [sum(r["labels"].count(k) for r in rows) for k in (0, 1)] and turns == sum(sum(r["turns"]) for r in rows)
