"""The whole pipeline on the given documents against the SQL of its stages, one after the other."""

import hashlib
import os
from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from playtrail.llm.oracles import OP4, OP6, OP8, OP9
from playtrail.llm.pieces import MODEL


@pytest.mark.skipif(not os.path.isfile(MODEL), reason="no model file here")
def test_run_against_the_chained_sql(spark, sf_dir):
    duck = duckdb.connect()
    duck.execute(f"CREATE TABLE documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    for kept in (f"SELECT doc_id FROM ({OP4}) WHERE kept", f"SELECT doc_id FROM ({OP9}) WHERE kept", f"SELECT component_id FROM ({OP6}) WHERE n_shingles > 0"):
        duck.execute(f"CREATE TABLE kept AS {kept}")
        duck.execute("CREATE TABLE rest AS SELECT * FROM documents WHERE doc_id IN (SELECT * FROM kept)")
        duck.execute("DROP TABLE documents")
        duck.execute("ALTER TABLE rest RENAME TO documents")
        duck.execute("DROP TABLE kept")
    copies = duck.execute(f"SELECT doc_id, taken // size FROM ({OP8}) WHERE taken > 0").fetchall()
    texts = dict(duck.execute("SELECT doc_id, text FROM documents").fetchall())
    found = corpus_pipeline.run(spark, sf_dir).collect()
    assert Counter(r.doc_id for r in found) == Counter({doc_id: int(n) for doc_id, n in copies})
    assert all(r.exact and r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() and r.n_ids == len(r.ids) for r in found)
    library = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=MODEL)
    assert all(library.encode(texts[r.doc_id]) == list(r.ids) for r in found[:40])
