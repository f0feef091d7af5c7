"""Every operator against plain code on the small table; all stages on it and on an empty one."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from playtrail.llm.components import components
from playtrail.llm.exact_dedup import drop_exact_copies, exact_groups
from playtrail.llm.line_dedup import _split, repeated_lines
from playtrail.llm.mixing import mix, mixed
from playtrail.llm.ngram_join import drop_near_copies, near_groups
from playtrail.llm.pieces import encode
from playtrail.llm.pii import find_pii
from playtrail.llm.quality import quality
from playtrail.llm.queries import op7_line_dedup
from playtrail.llm.sharding import N_SHARDS, shard_of, shuffled_shards, write_shards
from playtrail.llm.substring_dedup import repeated_passages
from playtrail.llm.toxicity import score, train
from tests.llm.cases import ROWS, table, words


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None)], "doc_id bigint, toxic int")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def rank(doc_id):
    return (doc_id is None, doc_id or 0)


def same(found, expected):
    assert Counter(map(tuple, found)) == Counter(map(tuple, expected))


OPERATORS = {
    "quality": quality,
    "exact_groups": exact_groups,
    "drop_exact_copies": drop_exact_copies,
    "shards": shuffled_shards,
    "mix": mix,
    "mixed": mixed,
    "near_groups": near_groups,
    "drop_near_copies": drop_near_copies,
    "passages": repeated_passages,
    "lines": repeated_lines,
    "pii": find_pii,
    "encode": encode,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables(docs, name):
    assert OPERATORS[name](docs.limit(0)).count() == 0


def test_quality(docs):
    found = quality(docs)
    assert found.where("kept").select("lang", "source", "row", "shard").columns == ["lang", "source", "row", "shard"]
    expected = []
    for doc_id, text in ROWS:
        own, lines = words(text), [line for line in (text or "").split("\n") if words(line)]
        windows = [tuple(own[k : k + 5]) for k in range(len(own) - 4)]
        times = Counter(windows)
        hit = {k + j for k, w in enumerate(windows) if times[w] > 1 for j in range(5)}
        expected.append((
            doc_id, len(own), sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(hit), len(own) < 10 or 100 * len(hit) > 20 * len(own),
        ))
    same(found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect(), expected)
    assert found.where("base_failed and kept").count() == 0


def exact_expected():
    groups = defaultdict(list)
    for k, (doc_id, text) in enumerate(ROWS):
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append(k)
    out = {}
    for plain, members in groups.items():
        best = min(members, key=lambda k: (-len(ROWS[k][1] or ""), rank(ROWS[k][0]), k))
        for k in members:
            out[k] = (ROWS[k][0], ROWS[best][0], len(members), k == best, sha(plain))
    return [out[k] for k in range(len(ROWS))]


@pytest.mark.parametrize("max_bytes", [1 << 12, 1 << 25])
def test_exact_groups(docs, max_bytes):
    same(exact_groups(docs, max_filter_bytes=max_bytes).collect(), exact_expected())


def test_exact_copies_go_with_all_columns_kept(docs):
    found = drop_exact_copies(docs)
    assert found.columns == docs.columns
    same([r.doc_id for r in found.collect()] and [(r.doc_id,) for r in found.collect()], [(r[0],) for r in exact_expected() if r[3]])


def test_shards_follow_the_law_of_keys(docs, tmp_path):
    many = docs.unionByName(docs.withColumn("doc_id", F.col("doc_id") + 1000))
    found = shuffled_shards(many, bucket_bytes=2000)
    assert found.columns == [c for c in docs.columns if c != "shard"] + ["shard", "slot"]
    rows = found.select("doc_id", "text", "shard", "slot", shard_of("doc_id", N_SHARDS + 1).alias("grown")).collect()
    assert len(rows) == 2 * len(ROWS)
    places = defaultdict(list)
    of_id = defaultdict(set)
    for row in rows:
        places[row.shard].append(row.slot)
        of_id[row.doc_id].add(row.shard)
        assert 0 <= row.shard < N_SHARDS and row.grown in (row.shard, N_SHARDS)
    assert all(sorted(slots) == list(range(len(slots))) for slots in places.values())
    assert all(len(shards) == 1 for shards in of_id.values())
    again = shuffled_shards(many.repartition(3), bucket_bytes=2000)
    assert sorted((r.doc_id or -1, r.slot) for r in again.collect()) == sorted((r.doc_id or -1, r.slot) for r in rows)
    write_shards(found, str(tmp_path / "shards"))
    assert found.sparkSession.read.parquet(str(tmp_path / "shards")).count() == len(rows)


def test_shuffle_moves_rows(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    order = [r.doc_id for r in shuffled_shards(docs, 1).orderBy("slot").collect()]
    assert sorted(order) == list(range(4000)) and order != list(range(4000))
    assert sum(a < b for a, b in zip(order, order[1:], strict=False)) < 2400
    assert Counter(r.shard for r in shuffled_shards(docs).collect()).most_common()[-1][1] > 150


def test_mix_meets_targets(spark):
    rows = spark.range(6000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "big").when(F.col("id") % 3 == 1, "mid").otherwise(None).alias("source"),
        F.array_join(F.array_repeat(F.lit("w"), (F.col("id") % 50).cast("int")), " ").alias("text"),
        F.lit("x").alias("taken"),
    )
    found = mix(rows).collect()
    assert [r.taken for r in mix(rows.repartition(5)).orderBy("doc_id").collect()] == [r.taken for r in sorted(found, key=lambda r: r.doc_id)]
    by_source = defaultdict(list)
    for row in found:
        assert row.taken in (0, row["size"], 2 * row["size"])
        by_source[row.source].append(row)
    total = sum(r["size"] for r in found)
    assert abs(sum(own[0].target for own in by_source.values()) - 1.5 * total) < 1e-6 * total
    for own in by_source.values():
        assert abs(sum(r.taken for r in own) - own[0].target) <= 49
    assert by_source["big"][0].target == 2 * by_source["big"][0].source_size
    copies = mixed(rows)
    assert copies.columns == rows.columns and copies.count() >= sum(r.taken > 0 for r in found)


def test_mix_of_awkward_rows(docs):
    rows = mix(docs).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.taken <= 2 * r["size"] for r in rows)


def near_expected():
    sets = []
    for _, text in ROWS:
        own = words(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        sets.append({tuple(own[k : k + 5]) for k in range(max(len(own) - 4, 1))} if own else set())
    group = list(range(len(ROWS)))
    for a, b in combinations(range(len(ROWS)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            old, new = group[b], group[a]
            group = [new if g == old else g for g in group]
    named = [min((ROWS[k][0] for k in range(len(ROWS)) if group[k] == g), key=rank) for g in group]
    return [(ROWS[k][0], len(sets[k]), named[k]) for k in range(len(ROWS))], group, sets


def test_near_groups(docs):
    same(near_groups(docs).collect(), near_expected()[0])


def test_one_of_each_near_group_stays(docs):
    found = drop_near_copies(docs)
    assert found.columns == docs.columns
    _, group, sets = near_expected()
    kept = [ROWS[k][0] for k in range(len(ROWS)) if not sets[k]]
    for g in {g for k, g in enumerate(group) if sets[k]}:
        kept.append(min((ROWS[k][0] for k in range(len(ROWS)) if group[k] == g and sets[k]), key=rank))
    same([(r.doc_id,) for r in found.collect()], [(k,) for k in kept])


def test_a_large_group_of_near_copies(spark):
    """Many different texts, each near the next: one component, though the ends are far apart."""
    texts = [" ".join(f"w{k + j}" for k in range(200)) for j in range(0, 300, 3)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert {r.component_id for r in near_groups(docs).collect()} == {0}


def test_components_of_a_long_path(spark):
    edges = [(k, k + 1) for k in range(1, 200)] + [(900, 901), (5, 5)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {**dict.fromkeys(range(1, 201), 1), 900: 900, 901: 900}


@pytest.mark.parametrize("window", [3, 50])
def test_passages(docs, window):
    own = [words(text) for _, text in ROWS]
    least = {}
    for (doc_id, _), ws in zip(ROWS, own, strict=True):
        for k in range(len(ws) - window + 1):
            key = tuple(ws[k : k + window])
            least[key] = min(least.get(key, rank(doc_id)), rank(doc_id))
    expected = []
    for (doc_id, _), ws in zip(ROWS, own, strict=True):
        gone = {
            k + j for k in range(len(ws) - window + 1) if least[tuple(ws[k : k + window])] < rank(doc_id) for j in range(window)
        }
        kept = [w for k, w in enumerate(ws) if k not in gone]
        expected.append((doc_id, len(ws), len(gone), sha(" ".join(kept))))
    found = repeated_passages(docs, window, min(window, 8)).select("doc_id", "n_words", "n_removed", "kept_sha256")
    same(found.collect(), expected)


def lines_expected(rows, min_words=1):
    index, seen, out = defaultdict(list), [], {}
    for doc_id, text in sorted(set(rows), key=lambda r: (rank(r[0]), r[1] or "")):
        kept = []
        for line in (text or "").split("\n"):
            own, hit = frozenset(words(line)), False
            if len(words(line)) >= min_words:
                shared = Counter(k for token in own for k in index[token])
                hit = any(100 * n >= 80 * (len(own) + len(seen[k]) - n) for k, n in shared.items())
                for token in own:
                    index[token].append(len(seen))
                seen.append(own)
            if not hit:
                kept.append(line)
        out[doc_id, text] = (doc_id, (text or "").count("\n") + 1, (text or "").count("\n") + 1 - len(kept), "\n".join(kept))
    return [out[row] for row in rows]


@pytest.mark.parametrize("hot_posts", [1, 20_000])
def test_lines(spark, docs, hot_posts):
    # Texts of rows without id come in no order that plain code could tell.
    rows = [row for row in ROWS if row[0] is not None or row[1] != "null id one"]
    for min_words in (1, 5):
        found = repeated_lines(table(spark, rows), min_words=min_words, hot_posts=hot_posts).select("doc_id", "n_lines", "n_removed", "kept_text")
        same(found.collect(), lines_expected(rows, min_words))


def test_lines_of_the_given_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    for hot_posts in (3, 20_000):
        found = repeated_lines(docs, hot_posts=hot_posts).select("doc_id", "n_lines", "n_removed", "kept_text")
        same(found.collect(), lines_expected(rows))


@pytest.mark.parametrize("hot_posts", [1, 20_000])
def test_short_lines(spark, sf_dir, hot_posts):
    """Every line with a word counts: equal ones of one to four words, and four words in five."""
    short = ["Read more", "more Read\nhome", "home\nHome\n\n\n \n", "a b c d\nall rights reserved", "a b c d e\nall  rights reserved\nall all rights", "Read more"]
    given = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = [row for row in ROWS if row[0] is not None or row[1] != "null id one"] + [(100 + k, t) for k, t in enumerate(short)]
    for df, rows in ((table(spark, rows), rows), (given, list(map(tuple, given.collect())))):
        found = repeated_lines(df, min_words=1, hot_posts=hot_posts).select("doc_id", "n_lines", "n_removed", "kept_text")
        same(found.collect(), lines_expected(rows, min_words=1))


def test_lines_are_not_joined_by_token(spark, monkeypatch):
    """Lines of one token meet in packed blocks: a join by token makes a row for each two of them."""
    kind = type(spark.range(0))
    on, join = [], kind.join
    monkeypatch.setattr(kind, "join", lambda self, other, by=None, how=None: on.append(by) or join(self, other, by, how))
    rows = [(i, " ".join(f"w{k}" for k in range(20) if k != i % 20) + f" a{i} b{i}") for i in range(60)]
    found = repeated_lines(table(spark, rows), hot_posts=7).select("doc_id", "n_lines", "n_removed", "kept_text")
    same(found.collect(), lines_expected(rows))
    assert on and all(isinstance(by, str | list) and "token" not in by for by in on)


def test_two_rows_of_a_token_meet_in_one_part():
    tokens, spots = np.repeat(np.arange(4, dtype=np.int32), [1, 50, 3, 9]), np.arange(63)
    rows, parts = _split(tokens, spots, np.array([1, 6, 1, 2], np.int32))
    met = defaultdict(set)
    for row, part in zip(rows.tolist(), parts.tolist(), strict=True):
        met[int(tokens[row]), part].add(row)
    together = {pair for own in met.values() for pair in combinations(sorted(own), 2)}
    assert together == {(a, b) for a, b in combinations(range(63), 2) if tokens[a] == tokens[b]}
    assert {row for own in met.values() for row in own} == set(range(63))


def test_the_query_of_lines_has_no_floor(spark, tmp_path):
    rows = [(1, "home\nRead more\nx"), (2, "Read more\nx\ny z"), (3, "z y\n\n\nw")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = op7_line_dedup(spark, str(tmp_path)).collect()
    same(found, [(i, n, gone, sha(kept)) for i, n, gone, kept in lines_expected(rows, min_words=1)])
    assert sum(r.n_removed for r in found) == 3


def test_toxicity_of_awkward_rows(docs, labels):
    for known in (labels, labels.limit(0)):
        rows = score(docs, train(docs, known)).collect()
        assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
    train(docs.limit(0), labels)


@pytest.mark.parametrize("toxic", [(0, 0, 0), (1, 1, 1), (1, 0, 1)])
def test_toxicity_of_one_class_of_labels_and_repeated_ids(spark, toxic):
    ids = [i for i in range(1, 60) if zlib.crc32(str(i).encode()) % 3 != 1][:3]
    rows = [(ids[0], "bad bad words"), *[(ids[1], f"text {k}") for k in range(500)], (ids[2], None), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    known = spark.createDataFrame(list(zip(ids, toxic, strict=True)), "doc_id bigint, toxic int")
    for some in (docs, docs.where(F.col("doc_id") == ids[0]), docs.limit(0)):
        scores = [r.score for r in score(docs, train(some, known)).collect()]
        assert len(scores) == len(rows) and all(0 <= s <= 1 for s in scores)


def test_the_pipeline_on_awkward_rows(spark, docs):
    """Against plain code: what stays after rules, exact and near copies; whole documents in the mix; exact ids."""
    at = {}
    for frame in (docs.limit(0), docs):
        step = frame.select("doc_id", "text", "lang", "source", "n_chars")
        for name, stage in corpus_pipeline.STAGES:
            before = step
            step = stage(spark, step, "")
            at[name] = step
            if name != "piece encoding":
                assert step.columns == before.columns
    kept = Counter(tuple(r) for r in quality(docs).where("kept").select("doc_id", "text").collect())
    assert Counter(tuple(r) for r in at["quality rules"].select("doc_id", "text").collect()) == kept
    texts = [(r.doc_id, r.text) for r in at["n-gram join"].collect()]
    assert texts and set(texts) <= set(kept)
    grams = [{tuple(words(t.lower())[k : k + 5]) for k in range(len(words(t)) - 4)} for _, t in texts]
    assert all(100 * len(a & b) < 80 * len(a | b) for a, b in combinations(grams, 2))
    assert at["piece encoding"].where("not exact").count() == 0
    assert at["piece encoding"].count() == at["mixing sources"].count()
