"""The pipeline's stages on a small corpus, and the registered queries."""

import __spark_entry__
import corpus_pipeline
from tidemark.llm import queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_every_operator_has_one_registered_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert {*queries.QUERIES, "pipeline"} <= set(__spark_entry__.queries())
    assert set(queries.ORACLES) <= set(__spark_entry__.oracle_sql())


def test_stages_take_effect_and_nothing_else_goes(spark, folder):
    word = [f"wort{n}" for n in range(400)]
    base = " ".join(word[:60])
    leak = " ".join(f"bench{chr(97 + n)}" for n in range(16))
    rows = [
        (1, base, "de", "s", 1),
        (2, base + " mehr", "de", "s", 1),
        (3, " ".join(word[100:140]) + "\nEine gemeinsame Zeile", "de", "s", 1),
        (4, " ".join(word[200:240]) + "\n eine gemeinsame zeile\n" + word[250], "de", "s", 1),
        (5, "12345 !!", "de", "s", 1),
        (6, None, None, None, None),
        (7, " ".join(word[300:330]) + " " + leak, "de", "s", 1),
    ]
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.createDataFrame(rows, SCHEMA)
    docs.write.parquet(f"{folder}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        seen[name] = {r["doc_id"]: r for r in docs.collect()} if name != "pack" else docs.collect()
        if name != "pack":
            assert tuple(docs.columns) == corpus_pipeline.COLUMNS
    assert set(seen["language"]) == {1, 2, 3, 4, 7}
    assert seen["line_dedup"][4]["text"] == " ".join(word[200:240]) + "\n" + word[250]
    assert seen["line_dedup"][4]["n_chars"] == len(seen["line_dedup"][4]["text"])
    assert set(seen["near_dedup"]) == {1, 3, 4, 7}
    assert set(seen["decontamination"]) == {1, 3, 4}
    assert sorted(r["doc_id"] for r in seen["pack"]) == [1, 3, 4] and len({r["sequence_id"] for r in seen["pack"]}) == 1
    ran = corpus_pipeline.run(spark, folder).collect()
    assert sorted((r["doc_id"], r["length"], r["ids_crc32"]) for r in ran) == sorted((r["doc_id"], r["length"], r["ids_crc32"]) for r in seen["pack"])


def test_an_empty_corpus_gives_no_sequences(spark, folder):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
