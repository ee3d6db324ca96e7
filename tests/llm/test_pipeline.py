import os
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from evolve.llm import line_dedup, queries
from evolve.llm.common import tokenizer
from tests.oracle import compare, duck

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    return " ".join(f"w{rng.randint(0, 500)}q" for _ in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with planted cases of every stage, and labels for half of the toxic ones."""
    rng = random.Random(5)
    rows, labels = [], []

    def add(text):
        rows.append((len(rows), text, "en", "s", None if text is None else len(text)))
        return len(rows) - 1

    for i in range(160):
        text = prose(rng, rng.randint(10, 80))
        labels.append((add(text if i % 3 else f"{text} you trashy vilex{i % 20} thing {prose(rng, 5)}"), 1, int(i % 3 == 0)))
    whole = prose(rng, 60)
    planted = {
        "toxic": add(prose(rng, 40) + " trashy vilex7 " + prose(rng, 40)), "null": add(None), "empty": add(""),
        "copy": add(whole), "again": add(whole.replace("w1", "W1")), "near": add(whole + " more"),
        "lines": add("a line that occurs in two of the documents here\n" + prose(rng, 20)),
        "lines2": add(prose(rng, 20) + "\na line that occurs in two of the documents hers\nshort"),
        "private": add(prose(rng, 20) + " write to me@site.example.org or 10.1.2.3 " + prose(rng, 5)),
    }
    at = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return at, planted, {r[0]: r for r in rows}


def test_every_stage_does_its_part(spark, folder):
    at, planted, rows = folder
    docs = spark.read.parquet(f"{at}/documents.parquet")
    seen = {}
    for name, stage in pipeline.STAGES[:-1]:
        docs = pipeline.stored(stage(spark, docs, at))
        assert docs.columns == [c.split()[0] for c in COLUMNS.split(", ")]
        seen[name] = {r["doc_id"]: r for r in docs.collect()}
    toxic, lines, near, private = (seen[n] for n, _ in pipeline.STAGES[:-1])
    assert planted["toxic"] not in toxic and {planted[k] for k in planted if k != "toxic"} <= set(toxic)
    clean = [i for i in range(160) if i % 3]
    assert sum(i in toxic for i in clean) >= len(clean) - 1
    assert lines[planted["lines"]]["text"] == rows[planted["lines"]][1]
    assert lines[planted["lines2"]]["text"] == "\n".join(t for t in rows[planted["lines2"]][1].split("\n") if not t.startswith("a line"))
    assert lines[planted["lines2"]]["n_chars"] == len(lines[planted["lines2"]]["text"])
    assert planted["copy"] in near and planted["again"] not in near and planted["near"] not in near
    assert {planted["null"], planted["empty"], planted["lines"], planted["lines2"]} <= set(near)
    assert private.keys() == near.keys() and private[planted["null"]]["text"] is None
    assert "me@site" not in private[planted["private"]]["text"] and "<email>" in private[planted["private"]]["text"] and "<ip>" in private[planted["private"]]["text"]
    pieces = pipeline.STAGES[-1][1](spark, docs, at).collect()
    coder = tokenizer("word_bpe_49k.json")
    assert sum(r["length"] for r in pieces) == sum(len(coder.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in private.values())
    assert sorted(map(tuple, pipeline.run(spark, at).collect())) == sorted(map(tuple, pieces))


def test_exact_copies_do_not_outlive_the_line_stage(spark):
    whole = "A title\n\nthe first of the longer lines of this text\nshort one\nand the second of the longer lines of it\n--"
    texts = [whole, whole, f" {whole}\n", "short one\nA title", whole + "\nits own end", None, "", "\n \n", "--\n--", "short one\nown"]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)] + [(None, whole, "en", "s", 0)], COLUMNS)
    got = {r["doc_id"]: r["text"] for r in pipeline.without_repeated_lines(spark, docs, "").collect()}
    assert got == {None: whole, 0: whole, 4: "\nits own end", 5: None, 6: "", 7: "\n \n", 8: "", 9: "own"}


def test_stages_take_further_columns_and_empty_tables(spark, folder):
    at, *_ = folder
    docs = spark.read.parquet(f"{at}/documents.parquet")
    wide = docs.withColumns({c: F.lit(1) for c in ("key", "id", "rep", "kept", "score", "spans", "component_id", "doc", "dropped")})
    for rows in (wide, wide.where("false")):
        for _, stage in pipeline.STAGES[:-1]:
            out = stage(spark, rows, at)
            assert out.columns == wide.columns and out.count() <= rows.count()
        pipeline.STAGES[-1][1](spark, rows, at).count()


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, name):
    assert compare(queries.QUERIES[name](spark, FOLDER), duck(FOLDER), queries.SQL[name]) is None


def test_the_line_stage_pairs_no_lines_that_only_share_a_segment(spark, documents, monkeypatch):
    rng = random.Random(31)
    letters = "abcdefghijklmnopqrstuvwxyz"
    heads = ["".join(rng.choices(letters, k=20)) for _ in range(8)]
    rows = [head + "".join(rng.choices(letters, k=40)) for head in heads for _ in range(20)]
    compared = []
    verified = line_dedup._verified
    monkeypatch.setattr(line_dedup, "_verified", lambda pairs, *more: compared.append(pairs.distinct().count()) or verified(pairs, *more))
    docs = documents(list(enumerate(rows))).withColumn("n_chars", F.length("text").cast("long"))
    assert pipeline.without_repeated_lines(spark, docs, "").count() == len(rows)
    assert sum(compared) <= 2 * len(rows)
