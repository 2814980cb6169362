from __future__ import annotations

import hashlib

import public_tokenizers
import tiktoken

import __spark_entry__
import corpus_pipeline
from tallyhouse.llm import bpe
from tests.llm import test_decontam, test_linededup, test_neardup
from tests.llm.helpers import SMALL, documents, whole, with_clashes


def test_stages_equal_brute_force_one_after_the_other(spark):
    """Each stage but the first against a plain version of it, on what its predecessor kept."""
    items = [(r["item_id"], r["text"]) for r in whole("benchmark")]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns and [t for _, t in out.dtypes] == [t for _, t in docs.dtypes]
        rows = out.collect()
        kept[name] = {r.doc_id: r.text for r in rows}
        assert len(kept[name]) == len(rows)
        docs = spark.createDataFrame(rows, out.schema)
    lines = {doc: text for doc, _, gone, text in test_linededup.brute_force(list(kept["quality_rules"].items())) if not gone or text.split()}
    assert kept["line_dedup"] == lines
    groups = test_neardup.brute_force(list(lines.items()), 5, 80)
    assert kept["near_dedup"] == {doc: lines[doc] for doc in lines if groups[doc][2]}
    clean = {doc: text for doc, text in kept["near_dedup"].items() if not test_decontam.brute_force(text, items)[1]}
    assert kept["decontamination"] == clean


def test_run_encodes_what_is_left(spark):
    ranks = bpe.load_ranks(public_tokenizers.path(bpe.VOCABULARY))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert 0 < len(rows) < len(whole("documents"))
    for row in rows[:50]:
        text = library.decode(bpe.np.frombuffer(row.token_ids, dtype="<u4").tolist())
        assert row.token_ids == bpe.np.array(library.encode_ordinary(text), dtype="<u4").tobytes()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_odd_rows(spark):
    good = "\n".join(" ".join(f"w{i}x{k}" for k in range(12)) for i in range(5))
    other = " ".join(f"other{k}" for k in range(30))
    rows = [(1, good), (2, good), (2, good), (3, None), (4, ""), (5, other), (None, other + " end"), (6, "x " * 50_000)]
    for df in (with_clashes(documents(spark, rows), "kept", "at", "root", "spans"), documents(spark, rows).limit(0)):
        docs = df
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SMALL)
            assert docs.columns == df.columns
        assert sorted((r.doc_id for r in docs.collect()), key=repr) == ([1, 5, None] if docs.count() else [])
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() == docs.count()


def test_texts_that_share_a_doc_id_are_documents_of_their_own(spark):
    a, b = (" ".join(f"{name}{k}" for k in range(30)) for name in "ab")
    for rows, kept in (
        ([(1, a), (5, a), (5, b), (7, b)], [(1, a), (5, b)]),
        ([(5, b), (5, a)], [(5, a), (5, b)]),
        ([(5, a, "x"), (5, a, "w"), (5, b + " end"), (4, b)], [(4, b), (5, a)]),
    ):
        out = corpus_pipeline.near_dedup(spark, with_clashes(documents(spark, rows)).repartition(3), SMALL).collect()
        assert sorted((r.doc_id, r.text) for r in out) == kept
        assert {r.lang for r in out} <= {None, "w"}


def test_registration():
    names = [n for n in __spark_entry__.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in __spark_entry__.queries()
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
