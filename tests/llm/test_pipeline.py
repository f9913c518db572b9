import random

import corpus_pipeline
from millrace.llm import byte_language, pigeonring, queries, secret_cnn
from test_pattern_packing import check
from test_pigeonring import brute_groups, brute_print
from test_byte_language import SOUNDS

import __spark_entry__ as entry_point


def words_of(lang, rng, n):
    return " ".join("".join(rng.choice(SOUNDS[lang]) for _ in range(3)) for _ in range(n))


def test_stages_against_plain_versions(spark, make_docs, store):
    rng = random.Random(3)
    docs = [(i, words_of(lang, rng, rng.randint(40, 90)), lang) for i, lang in ((i, rng.choice(list(SOUNDS))) for i in range(150))]
    item = words_of("en", rng, 30)
    docs += [(200, docs[3][1], docs[3][2]), (201, docs[4][1].upper(), docs[4][2]), (202, None, "en"), (203, "12 34", "fr"), (204, "", "de")]
    docs += [(205, docs[7][1] + " " + item + " " + docs[8][1], "en"), (206, docs[9][1] + " password=abcdef123456 " + docs[10][1], "fr")]
    frame = make_docs(docs)
    benchmark = spark.createDataFrame([(0, item), (1, words_of("de", rng, 25))], "item_id long, text string")
    folder = store(documents=frame, benchmark=benchmark)

    kept = frame
    texts = {d[0]: d[1] for d in docs}
    expected = dict(texts)
    for i in (202, 203, 204):
        del expected[i]
    steps = [set(expected)]
    groups = brute_groups({i: brute_print(t) for i, t in expected.items()}, 4)
    expected = {i: t for i, t in expected.items() if groups[i] == i}
    steps.append(set(expected))
    expected.pop(205)
    steps += [set(expected), set(expected)]
    expected[206] = texts[206].replace("password=abcdef123456", "[secret]")
    for (name, stage), ids in zip(corpus_pipeline.STAGES, steps):
        kept = stage(spark, kept, folder)
        assert kept.columns == frame.columns, name
        assert sorted(r["doc_id"] for r in kept.collect()) == sorted(ids), name
    assert {r["doc_id"]: r["text"] for r in kept.collect()} == expected
    assert all(r["n_chars"] == len(r["text"]) for r in kept.collect())
    check(corpus_pipeline.run(spark, folder).collect(), list(expected.items()), 1024)


def test_stages_take_empty_and_odd_tables(spark, make_docs, store):
    folder = store(benchmark=spark.createDataFrame([(0, "a b c d e f g")], "item_id long, text string"))
    for rows in ([], [(None, None), (None, None), (1, "the of and"), (1, "the of and")]):
        kept = make_docs(rows, ["piece", "kinds_of"])
        for name, stage in corpus_pipeline.STAGES:
            kept = corpus_pipeline.materialize(stage(spark, kept, folder), name)
        assert kept.count() <= len(rows)


def test_stages_carry_columns_named_like_results(make_docs):
    rng = random.Random(5)
    docs = [(i, words_of(lang, rng, 40), lang) for i, lang in enumerate(sorted(SOUNDS) * 10)] + [(90, "token=abcdef123456 " + words_of("en", rng, 40), "en")]
    names = ["score", "held_out", "lang_pred", "text_to_read", "print", "component_id", "component", "node", "rep", "least", "kinds",
             "starts", "ends", "cuts", "carried_0"]
    frame = make_docs(docs, names)
    for stage in (byte_language.known, pigeonring.one_of_each, secret_cnn.redact):
        kept = stage(frame)
        assert kept.columns == frame.columns and kept.schema.simpleString() == frame.schema.simpleString()
        rows = kept.collect()
        assert len(rows) == len(docs) and all(r[n] == "x" for r in rows for n in names)


def test_one_query_for_every_operator():
    names = [n for n in entry_point.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and set(names) == set(queries.QUERIES)
    assert "pipeline" in entry_point.queries() and [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "simhash_near_duplicates", "decontamination", "secret_scan", "packing"]
