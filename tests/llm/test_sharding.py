from collections import Counter, defaultdict

import duckdb

from tests.llm.samples import EDGES, text
from tidemart.llm import sharding, sql
from tidemart.llm.sharding import ShardParams, shard, write_shards


def rows_of(df):
    return sorted(((r.doc_id, r.n_bytes, r.shard, r.shard_bytes, r.shard_rows, r.oversized) for r in df.collect()), key=repr)


def test_equals_sql_on_a_small_limit(spark):
    path = "/root/testdata/sf0.001/documents.parquet"
    for limit in (1 << 20, 20_000, 3_000):
        theirs = duckdb.sql(
            f"SELECT doc_id, n_bytes, shard, shard_bytes, shard_rows, oversized FROM ({sql.SHARDING.format(docs=repr(path), limit=limit)})").fetchall()
        for spare, more in ((3, 8), (0, 1)):
            mine = rows_of(shard(spark.read.parquet(path), ShardParams(limit, spare, more)))
            assert mine == sorted(theirs, key=repr)


def test_shards_fit_and_hot_keys_split(docs):
    rows = [(i, text(i, 20)) for i in range(100)] + [(7, text(1000 + i, 30)) for i in range(60)] + [(8, "same text " * 10)] * 80
    got = shard(docs(*rows), ShardParams(2_000)).collect()
    assert len(got) == len(rows) and sorted(r.doc_id for r in got) == sorted(i for i, _ in rows)
    sums, counts = defaultdict(int), defaultdict(int)
    for r in got:
        sums[r.shard] += r.n_bytes
        counts[r.shard] += 1
    assert all(r.shard_bytes == sums[r.shard] <= 2_000 and r.shard_rows == counts[r.shard] and not r.oversized for r in got)
    names = sorted(sums)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:]) if "." not in b)
    assert len({r.shard for r in got if r.doc_id == 8}) >= 4


def test_edge_cases(docs):
    got = shard(docs(*EDGES), ShardParams(1_000)).collect()
    assert len(got) == len(EDGES)
    assert {r.doc_id for r in got if r.oversized} == {906}
    assert [r.shard_rows for r in got if r.doc_id == 906] == [1]
    assert shard(docs((1, "a")).where("false")).count() == 0


def test_written_shards_hold_all_rows(docs, spark, tmp_path):
    df = docs(*[(i, text(i, 30)) for i in range(50)], clash=False)
    placed = write_shards(df, str(tmp_path / "out"), ShardParams(1_500))
    again = spark.read.parquet(str(tmp_path / "out"))
    assert {(r.doc_id, str(r.shard)) for r in again.collect()} == {(r.doc_id, r.shard) for r in placed.collect()}


def test_written_shards_hold_repeated_rows_and_hot_keys_once(docs, spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sharding, "RUN", 7)
    rows = [(i, text(i, 20)) for i in range(60)] + [(7, text(1000 + i, 30)) for i in range(40)] + [(8, "same text " * 10)] * 80
    rows += [(None, "no id"), (None, "no id"), (5, None), (5, None), (5, "")]
    placed = write_shards(docs(*rows, clash=True), str(tmp_path / "out"), ShardParams(2_000))
    again = [(r.doc_id, r.text, str(r._shard)) for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert Counter((d, t) for d, t, _ in again) == Counter(rows)
    assert Counter((d, s) for d, _, s in again) == Counter((r.doc_id, r.shard) for r in placed.collect())
    sizes = Counter()
    for _, t, s in again:
        sizes[s] += len((t or "").encode())
    assert max(sizes.values()) <= 2_000
