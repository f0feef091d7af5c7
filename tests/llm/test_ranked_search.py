"""Ranked search against plain scoring of every document."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from playtrail.llm.queries import op13_ranked_search
from playtrail.llm.ranked_search import search
from tests.llm.cases import ROWS, table

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def ranked(docs, items, top=10):
    own = [(doc_id, terms(text)) for doc_id, text in docs]
    own = [(doc_id, Counter(found), len(found)) for doc_id, found in own if found]
    n_docs, all_terms = len(own), sum(n for _, _, n in own)
    df = Counter(term for _, counts, _ in own for term in counts)
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, counts, n in own:
            m = 10 + 90 * n * n_docs // all_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * counts[t] // (1000 * counts[t] + 8 * m))
                for t in set(terms(text)) if t in counts
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        out += [(item_id, rank, None if no_id else doc_id, -score) for rank, (score, no_id, doc_id) in enumerate(sorted(scored)[:top], 1)]
    return Counter(out)


ITEMS = [
    (0, "w1 w2 w60 x60"), (1, "The P3 p30; q30 of-of"), (2, None), (3, ""), (4, " .,;"), (5, "日本 éé tie"), (6, "nothing known here?"),
    (7, "one TWO"), (7, "one TWO"), (None, "row words"), (8, " ".join(f"v{k}" for k in range(900))),
]


@pytest.mark.parametrize("block_terms", [3, 1 << 18])
def test_awkward_rows(spark, block_terms):
    docs = table(spark)
    items = spark.createDataFrame([(*row, "s") for row in ITEMS], "item_id bigint, text string, score string")
    for top in (1, 10):
        found = search(docs, items, top=top, block_terms=block_terms)
        assert found.columns == ["item_id", "rank", "doc_id", "score"]
        assert Counter(map(tuple, found.collect())) == ranked(ROWS, ITEMS, top)


def test_empty_tables(spark):
    docs, items = table(spark), spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert search(docs.limit(0), items).count() == 0 and search(docs, items.limit(0)).count() == 0


def test_a_large_class_and_ties(spark):
    """Two thirds of the documents say the same; equal scores of different classes go by id across them."""
    draw = random.Random(2)
    rows = [(k, "common words here" if draw.random() < 0.66 else draw.choice(["words common there", "here common words", f"rare{k % 7} words"])) for k in range(3000)]
    draw.shuffle(rows)
    items = [(1, "common words"), (2, "here"), (3, "rare3 rare4"), (4, "there words")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    found = search(docs, spark.createDataFrame(items, "item_id bigint, text string"))
    assert Counter(map(tuple, found.collect())) == ranked(rows, items)


def test_query_on_a_folder(spark, tmp_path, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/documents.parquet").where(F.col("doc_id") % 2 == 0).select("doc_id", "text")
    given.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{sf_dir}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{tmp_path}/benchmark.parquet").collect()]
    found = op13_ranked_search(spark, str(tmp_path))
    assert Counter(map(tuple, found.collect())) == ranked([(r.doc_id, r.text) for r in given.collect()], items)
