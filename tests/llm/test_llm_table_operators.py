"""Search, sharding, counts, mixing, packing and the pipeline."""

import zlib

import corpus_pipeline
import llm_cases as cases
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tickfold.llm import histogram_sort as hs
from tickfold.llm.best_fit import best_fit, pack, pack_tokens, sequences
from tickfold.llm.histogram_sort import histogram_sort
from tickfold.llm.multi_index import Block, Codes, nearest
from tickfold.llm.queries import END_ID, ORACLES, QUERIES, TOKENIZER, packed_documents
from tickfold.llm.raking import draw, mix
from tickfold.llm.token_counts import Rollup, event, signed
from tickfold.session import shared_folder

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(cases.rows(), cases.SCHEMA)


def test_nearest(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(900, 12)) * rng.uniform(0.5, 2, (900, 1))
    x[300:340] = x[20]  # ties
    x = x.astype(np.float32)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    odd = [None, [], [0.0] * 12, [1.0] * 11, [float("nan")] + [1.0] * 11, [None] + [1.0] * 11]
    rows += [(20 * (100 + i), v, 0) for i, v in enumerate([*odd, [float("inf")] * 12])]
    rows.append((None, [1.0] * 12, 0))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    got = {}
    for r in nearest(df, F.col("id") % 20 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(got) == list(range(0, 900, 20))
    x, recall, ids = x.astype(np.float64), [], np.arange(900)
    for q, found in got.items():
        score = x @ x[q]
        score[q] = -np.inf
        want = np.lexsort((ids, -score))[:20]
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 21))
        assert np.allclose([s for _, _, s in found], score[[i for _, i, _ in found]])
        assert found == sorted(found, key=lambda r: (-r[2], r[1]))
        recall.append(len({i for _, i, _ in found} & set(want.tolist())) / 20)
    assert np.mean(recall) >= 0.95
    tied = [i for _, i, _ in sorted(got[20])]
    assert [i for i in tied if 300 <= i < 340] == sorted(i for i in tied if 300 <= i < 340)


def test_probing_finds_every_code_within_the_radius():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 20))
    codes = Codes(x, float(np.linalg.norm(x, axis=1).max()))
    block = Block(np.arange(500), x, codes)
    asked = codes.of_queries(x[:20])
    for radius in (0, 7, 8, 13, 20, 31, 64):
        for code in asked:
            far = np.unpackbits(block.code ^ code, axis=1).sum(1)
            assert block.within(code, radius).tolist() == np.flatnonzero(far <= radius).tolist()


def test_few_candidates(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = nearest(df, F.col("id") % 20 == 0).collect()
    assert [tuple(r) for r in got] == [(0, 1, 2, 1.0), (0, 2, 1, 0.5)]


@pytest.mark.parametrize("shards", [1, 4, 40])
def test_histogram_sort(docs, shards):
    got = {r["doc_id"]: r for r in histogram_sort(docs, shards).collect()}
    sizes, slots = [0] * shards, [[] for _ in range(shards)]
    for r in cases.rows():
        b = (r[1] or "").encode()
        g = got[r[0]]
        assert (g["size"], g["text_crc32"]) == (len(b) + 16, zlib.crc32(b))
        sizes[g["shard"]] += g["size"]
        slots[g["shard"]].append(g["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots)
    largest = max(g["size"] for g in got.values())
    assert max(sizes) - min(sizes) <= 2 * largest + sum(sizes) * 0.01


def test_histogram_sort_cuts_one_text(spark):
    rows = [(i, "same text") for i in range(4000)] + [(i, f"other {i}") for i in range(4000, 6000)]
    placed = histogram_sort(spark.createDataFrame(rows, "doc_id long, text string"), 8).collect()
    sizes = np.zeros(8)
    for r in placed:
        sizes[r["shard"]] += r["size"]
    assert sizes.max() / sizes.min() < 1.02
    same = [r for r in placed if r["doc_id"] < 4000]
    assert len({r["shard"] for r in same}) <= 6 + 1


def test_repeated_rows_get_slots(spark):
    rows = [(1, "a")] * 5 + [(None, None)] * 2
    placed = histogram_sort(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()
    assert len(placed) == 7
    assert len({(r["shard"], r["slot"]) for r in placed}) == 7
    assert hs.RANGE_SHARE > 1


def test_rollup(spark):
    rollup = Rollup(spark, shared_folder(spark, "rollup"))
    at = lambda s, v, n: {"source": F.lit(s), "version": F.lit(v), "tokens": F.lit(n)}
    totals = lambda: sorted(tuple(r) for r in rollup.totals().collect())
    assert totals() == []
    one = spark.range(3)
    assert rollup.commit(1, one.select(*event("insert", at("a", "1", 10), {})))
    assert not rollup.commit(1, one.select(*event("insert", at("a", "1", 10), {})))
    gone = spark.range(1).select(*event("delete", {}, at("a", "1", 10)))
    assert rollup.commit(2, gone)
    assert rollup.commit(7, spark.range(1).select(*event("revise", at("b", "2", 7), at("a", "1", 10))))
    assert rollup.commit(4, gone.where("false"))
    want = [("a", None, "1", 1, 10), ("b", None, "2", 1, 7)]
    assert totals() == want
    assert [rollup.committed(b) for b in range(1, 9)] == [True, True, False, True, False, False, True, False]
    assert rollup.compact() and totals() == want
    assert not rollup.commit(2, gone) and totals() == want  # compacted batches stay known
    assert rollup.commit(3, spark.range(1).select(*event("delete", {}, at("b", "2", 7))))
    assert totals() == want[:1]


def test_rollup_compacts_without_loss(spark):
    """Batches in any order, each given twice; sums take the place of folders on the way."""
    rollup = Rollup(spark, shared_folder(spark, "rollup"), merge_above=3)
    for batch in (5, 1, 9, 2, 8, 3, 4, 7, 6, 10):
        events = spark.range(batch).select(
            *event("insert", {"source": F.lit("s"), "tokens": F.lit(batch)}, {})
        )
        assert rollup.commit(batch, events) and not rollup.commit(batch, events)
    assert [tuple(r) for r in rollup.totals().collect()] == [("s", None, None, 55, 385)]
    state = rollup.log.latest(spark)
    assert len(state.folders["sums"]) <= 4 and state.state["batches"] == [[1, 10]]


def test_unfinished_batch_is_replaced(spark):
    rollup = Rollup(spark, shared_folder(spark, "rollup"))
    new = {"source": F.lit("a"), "tokens": F.lit(1)}
    events = spark.range(2).select(*event("insert", new, {}))
    rollup.log.stage(signed(events))  # a job that died before its commit
    assert rollup.totals().collect() == [] and not rollup.committed(1)
    assert rollup.commit(1, events)
    assert [tuple(r) for r in rollup.totals().collect()] == [("a", None, None, 2, 2)]


def test_mix_meets_the_targets(docs):
    counted = docs.select(
        "doc_id", "source", "lang", F.lit(None).cast("string").alias("topic"), F.length("text").alias("n_tokens")
    )
    powers = {"source": 0.5, "lang": 0.5, "topic": 1.0}
    out = mix(counted, powers).toPandas()
    assert len(out) == len(cases.rows())
    assert out.probability.max() == pytest.approx(1.0) and out.probability.min() >= 0
    out["want"] = out.probability * out.n_tokens
    for d in ("source", "lang"):
        tokens = out.groupby(d, dropna=False).n_tokens.sum() ** 0.5
        share = out.groupby(d, dropna=False).want.sum() / out.want.sum()
        assert np.allclose(share, tokens / tokens.sum(), atol=1e-4)
    draws = [r[0] for r in docs.select(draw(F.col("doc_id"))).collect()]
    assert min(draws) >= 0 and max(draws) < 1 and 0.3 < np.mean(draws) < 0.7


def test_pack():
    rng = np.random.default_rng(3)
    sizes = np.sort(rng.integers(0, 900, 700))[::-1]
    bins, starts, final = pack(sizes, (128, 256, 1000))
    places = {}
    for size, b, start, capacity in zip(sizes, bins, starts, final, strict=True):
        assert start + size <= capacity
        places.setdefault(b, (capacity, []))[1].append((start, size))
    for capacity, held in places.values():
        end = 0
        for start, size in sorted(held):
            assert start == end
            end += size
        assert not [c for c in (128, 256, 1000) if end <= c < capacity]
    total = sum(c for c, _ in places.values())
    assert sizes.sum() / total > 0.97


def test_best_fit(spark):
    rows = [(1, 20_000), (2, None), (3, 0), (4, -5), (5, 100), (5, 100), (None, 7)]
    df = spark.createDataFrame(rows, "doc_id long, n_tokens long")
    out = best_fit(df).toPandas()
    assert out[out.doc_id == 1].sort_values("piece").n_tokens.tolist() == [8192, 8192, 3616]
    assert out[out.doc_id == 1].sort_values("piece").first_token.tolist() == [0, 8192, 16384]
    assert out.n_tokens.sum() == 20_207 and len(out) == 9
    assert (out.bin_start + out.n_tokens <= out.capacity).all()


def test_packed_ids_are_those_of_whole_texts(spark, docs):
    """Pieces and sequences give back the ids of each text, encoded whole."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(TOKENIZER))
    pieces = packed_documents(docs.withColumn("copy", F.lit("x")).withColumn("ids", F.lit(1)))
    rows = pieces.collect()
    texts = docs.select("doc_id", "text").collect()
    want = sorted(
        (r.doc_id is None, r.doc_id or 0, [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, END_ID])
        for r in texts
    )
    by_doc = {}
    for r in sorted(rows, key=lambda r: r.first_token):
        assert len(r.ids) == r.n_tokens > 0 and r.bin_start + r.n_tokens <= r.capacity
        by_doc.setdefault(r.doc_id, []).extend(r.ids)
    single = {}
    for _, i, ids in want:
        single.setdefault(i, []).append(ids)
    for i, lists in single.items():
        if len(lists) == 1 and i in by_doc:
            assert by_doc[i] == lists[0]
    assert sorted(t for ids in by_doc.values() for t in ids) == sorted(t for *_, ids in want for t in ids)
    place = {}
    for r in rows:
        for at, token in enumerate(r.ids):
            assert place.setdefault((r.bin_id, r.bin_start + at), (r.doc_id, r.piece, token)) == (r.doc_id, r.piece, token)
    whole = sequences(pieces).collect()
    assert len(whole) == len({r.bin_id for r in rows})
    for s in whole:
        assert len(s.ids) <= s.capacity and s.starts == sorted(s.starts)
        assert s.ids == [place[s.bin_id, at][2] for at in range(len(s.ids))]
    assert sum(len(s.ids) for s in whole) == len(place)


def test_packed_ids_of_odd_lists(spark):
    lists = [(1, list(range(20_000))), (2, None), (3, []), (None, [7]), (5, [1, 2]), (5, [1, 2]), (5, [9])]
    df = spark.createDataFrame(lists, "doc_id long, ids array<int>")
    out = pack_tokens(df).collect()
    assert [r.n_tokens for r in sorted(out, key=lambda r: r.piece) if r.doc_id == 1] == [8192, 8192, 3616]
    long = [t for r in sorted(out, key=lambda r: r.piece) if r.doc_id == 1 for t in r.ids]
    assert long == list(range(20_000))
    rest = sorted((r.doc_id or 0, r.ids) for r in out if r.doc_id != 1)
    assert rest == [(0, [7]), (2, []), (3, []), (5, [1, 2]), (5, [1, 2]), (5, [9])]


@pytest.mark.parametrize("name", list(QUERIES))
def test_empty_tables(spark, tmp_path, name):
    for t in ("documents", "embeddings", "labels"):
        spark.read.parquet(f"{FOLDER}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert QUERIES[name](spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_its_sql(spark, name):
    from check_oracles import compare, tables

    assert compare(spark, tables(FOLDER), name, FOLDER)[0]


def test_pipeline_stages(spark, docs):
    """Each stage on the odd table, written and read as the runner does."""
    now = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES:
        path = shared_folder(spark, name)
        stage(spark, now, FOLDER).write.parquet(path)
        out = spark.read.parquet(path)
        if name != "packing":
            assert out.columns == now.columns
            assert out.count() <= now.count()
            now = out
    assert out.count() > 0
    assert {"doc_id", "bin_id", "capacity"} <= set(out.columns)


def test_pipeline_runs_on_a_table(spark):
    out = corpus_pipeline.run(spark, FOLDER)
    assert out.count() > 50


def raked(cells, powers):
    """Plain-Python raking until nothing moves, for cells {(source, lang, topic): tokens}."""
    axes = list(powers)
    targets = []
    for i, d in enumerate(axes):
        own = {}
        for key, n in cells.items():
            own[key[i]] = own.get(key[i], 0) + n
        own = {v: n ** powers[d] for v, n in own.items()}
        targets.append({v: n / sum(own.values()) for v, n in own.items()})
    weight = {k: float(n) for k, n in cells.items()}
    for _ in range(400):
        for i in range(len(axes)):
            mass = {}
            for key, w in weight.items():
                mass[key[i]] = mass.get(key[i], 0) + w
            weight = {k: w * targets[i][k[i]] / mass[k[i]] for k, w in weight.items()}
    return weight


def mixture_rows(n=900):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(n):
        source = ["hot", "b", None][int(rng.choice(3, p=[0.7, 0.2, 0.1]))]
        lang = ["en", "de", "fr"][int(rng.integers(3))]
        rows.append((i, source, lang, ["x", "y"][int(rng.integers(2))], int(rng.integers(0, 500))))
    return rows


@pytest.mark.parametrize("share", [0.2, 0.75, 1.0])
def test_mix_equals_plain_raking(spark, share):
    rows = [*mixture_rows(), (-1, "rare", "en", "x", 20)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, topic string, n_tokens long")
    powers = {"source": 0.8, "lang": 0.9, "topic": 0.9}
    out = {r["doc_id"]: r for r in mix(df, powers, share=share).collect()}
    cells = {}
    for _, s, lang, t, n in rows:
        cells[s, lang, t] = cells.get((s, lang, t), 0) + n
    weight, total = raked(cells, powers), sum(cells.values())
    low, high = 0.0, 1e12
    for _ in range(200):  # the factor by bisection
        factor = (low + high) / 2
        low, high = (factor, high) if sum(min(n, factor * weight[k]) for k, n in cells.items()) < share * total else (low, factor)
    for i, s, lang, t, _ in rows:
        want = min(1.0, high * weight[s, lang, t] / cells[s, lang, t])
        assert out[i]["probability"] == pytest.approx(want, abs=1e-4)
        draw = int(cases.hashlib.md5(str(i).encode()).hexdigest()[:13], 16) / 16**13
        assert out[i]["sampled"] == (draw < out[i]["probability"])
        assert out[i]["gap"] <= 1e-6
    kept = sum(r["n_tokens"] * r["probability"] for r in out.values())
    assert kept == pytest.approx(share * total, rel=1e-3)


def test_contradictory_targets_show_their_gap(spark):
    """All of one language in one source of its own: both targets cannot be met."""
    rows = [r for r in mixture_rows() if r[1] == "hot"]
    rows += [(10_000 + i, "only", "es", "x", 30) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, topic string, n_tokens long")
    out = mix(df, {"source": 0.5, "lang": 0.9, "topic": 0.9}).collect()
    assert len(out) == len(rows) and out[0]["gap"] > 0.01


def test_best_fit_deals_out_equal_rows(spark, monkeypatch):
    from tickfold.llm import best_fit as bf

    monkeypatch.setattr(bf, "BLOCK_PIECES", 500)
    monkeypatch.setattr(bf, "COPIES_AT_ONCE", 100)
    same = spark.range(1900).selectExpr("CAST(NULL AS LONG) AS doc_id", "30 AS n_tokens", "'x' AS `a.b`")
    others = spark.range(600).selectExpr("IF(id < 300, 7, id) AS doc_id", "30 AS n_tokens", "'x' AS `a.b`")
    out = best_fit(same.unionAll(others)).toPandas()
    assert len(out) == 2500 and out.doc_id.isna().sum() == 1900 and (out.doc_id == 7).sum() == 300
    assert (out.bin_id // 2**32).value_counts().max() < 650


@pytest.mark.parametrize("norms", ["unit", "outlier", "lognormal"])
def test_recall_with_any_norms(norms):
    """One block of vectors about clusters: recall over all queries, and of the worst tenth."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(60, 64))[rng.integers(0, 60, 6000)] + rng.normal(size=(6000, 64)) * 0.8
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if norms == "outlier":
        x[17] *= 3
    if norms == "lognormal":
        x *= np.exp(rng.normal(size=(6000, 1)) * 0.3)
    queries, ids, recall = np.arange(0, 6000, 40), np.arange(6000), []
    codes = Codes(x, float(np.linalg.norm(x, axis=1).max()), x[queries])
    block = Block(ids, x, codes)
    for q, code in zip(queries, codes.of_queries(x[queries]), strict=True):
        found, _ = block.nearest(int(q), x[q], code, 20)
        score = x @ x[q]
        score[q] = -np.inf
        recall.append(len({*found} & {*np.lexsort((ids, -score))[:20]}) / 20)
    assert np.mean(recall) >= 0.95 and np.mean(sorted(recall)[:15]) >= 0.8


def test_nearest_over_norm_classes_and_blocks(spark, monkeypatch):
    from tickfold.llm import multi_index as mi

    monkeypatch.setattr(mi, "BLOCK", 700)
    monkeypatch.setattr(mi, "CHUNK", 50)
    rng = np.random.default_rng(9)
    x = (rng.normal(size=(3000, 24)) * np.exp(rng.normal(size=(3000, 1)) * 0.3)).astype(np.float32)
    x[7] *= 5
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {}
    for r in nearest(df, F.col("id") % 20 == 0).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    x, ids, recall = x.astype(np.float64), np.arange(3000), []
    for q, found in got.items():
        score = x @ x[q]
        score[q] = -np.inf
        recall.append(len(found & {*np.lexsort((ids, -score))[:20].tolist()}) / 20)
    assert len(got) == 150 and np.mean(recall) >= 0.95 and min(recall) >= 0.6


def test_pipeline_stages_keep_odd_columns(spark, docs):
    """Extra columns whose names need quotes or are used inside the stages."""
    now = docs.select(
        "doc_id", "text", "lang", "source", "n_chars",
        F.lit("x").alias("a.b"), "row", "found", "w", F.lit(1).alias("base"), F.lit(2).alias("topic"),
        F.lit(3).alias("n_tokens"), F.lit(4).alias("kept words"), F.lit(5).alias("hashes"),
    )
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = shared_folder(spark, name)
        stage(spark, now, FOLDER).write.parquet(path)
        out = spark.read.parquet(path)
        assert out.columns == now.columns, name
        assert {r["a.b"] for r in out.select("`a.b`").collect()} == {"x"}
        now = out
    assert corpus_pipeline.STAGES[-1][1](spark, now, FOLDER).count() > 0
