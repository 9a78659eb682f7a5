import datetime as dt
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from orbitlens.sources import row_groups as rgs

BASE = dt.datetime(2020, 1, 1)


def write_archive(path, sizes, first=0):
    """A file whose row groups have the given sizes."""
    path.parent.mkdir(parents=True, exist_ok=True)
    schema = pa.schema([("t", pa.timestamp("us")), ("id", pa.int64()), ("v", pa.float64())])
    with pq.ParquetWriter(path, schema) as writer:
        for n in sizes:
            ids = list(range(first, first + n))
            writer.write_table(pa.table([[BASE + dt.timedelta(seconds=i) for i in ids], ids, [i / 2 for i in ids]], schema), row_group_size=max(n, 1))
            first += n
    return list(range(first - sum(sizes), first))


@pytest.fixture
def uneven(tmp_path):
    rng = random.Random(4)
    sizes = {"a_2020.parquet": [rng.randrange(1, 40) for _ in range(11)], "2021/x.parquet": [3], "2021/y.parquet": [5, 1, 7],
             "none.parquet": [4], "_hidden_2022.parquet": [2]}
    ids = {name: write_archive(tmp_path / "in" / name, groups, 1000 * i) for i, (name, groups) in enumerate(sizes.items())}
    return tmp_path, sizes, ids


@pytest.mark.parametrize("limit", [None, 7, 0])
def test_chunks_follow_real_row_groups(spark, uneven, limit):
    folder, sizes, ids = uneven
    target = folder / f"out{limit}"
    rgs.rechunk(spark, str(folder / "in"), str(target), groups_per_chunk=4, group_limit=limit)
    want = {}
    for name, below in (("a_2020.parquet", "2020"), ("2021/x.parquet", "2021/2021_x"), ("2021/y.parquet", "2021/2021_y")):
        groups = sizes[name][:limit]
        for first in range(0, len(groups), 4):
            stop = min(first + 4, len(groups))
            a, b = sum(groups[:first]), sum(groups[:stop])
            want[f"{below}/row_groups_{first:05d}_to_{stop:05d}.parquet"] = ids[name][a:b]
    found = {str(p.relative_to(target)): pq.read_table(p) for p in target.rglob("*.parquet")} if target.exists() else {}
    assert {n: t["id"].to_pylist() for n, t in found.items()} == want
    assert all(t.schema.names == ["t", "id", "v"] for t in found.values())
    if want:
        listed = {r["path"].split(f"out{limit}/")[1]: (r["rows"], r["start"], r["end"]) for r in rgs.list_files(spark, str(target), "t").collect()}
        assert listed == {n: (len(x), BASE + dt.timedelta(seconds=x[0]), BASE + dt.timedelta(seconds=x[-1])) for n, x in want.items()}


def test_groups_beyond_the_cap_are_not_read(spark, uneven):
    """A file with broken pages beyond the cap is read without harm."""
    folder, sizes, ids = uneven
    path = folder / "in" / "a_2020.parquet"
    footer = pq.read_metadata(path)
    at = footer.row_group(8).column(1).data_page_offset
    data = bytearray(path.read_bytes())
    data[at - 4:at + 60] = b"\xff" * 64
    path.write_bytes(bytes(data))
    rgs.register(spark)
    rows = spark.read.format("row_groups").option("groups_per_chunk", 2).option("group_limit", 8).load(str(path))
    assert sorted(r["id"] for r in rows.select("id").collect()) == ids["a_2020.parquet"][:sum(sizes["a_2020.parquet"][:8])]
    assert rows.rdd.getNumPartitions() == 4


def test_columns_and_places(spark, uneven):
    folder, sizes, _ = uneven
    rgs.register(spark)
    rows = spark.read.format("row_groups").option("columns", '["v"]').load(str(folder / "in"))
    assert rows.columns == ["v", "archive", "year", "chunk", "stop", "file_name"]
    got = {(r["year"], r["chunk"], r["stop"]) for r in rows.select("year", "chunk", "stop").distinct().collect()}
    assert got == {(2020, 0, 10), (2020, 10, 11), (2021, 0, 1), (2021, 0, 3)}


def test_existing_files_are_kept_unless_overwritten(spark, uneven):
    folder, _, _ = uneven
    out = str(folder / "again")
    rgs.rechunk(spark, str(folder / "in"), out)
    before = sorted((p.name, p.stat().st_size) for p in (folder / "again").rglob("*"))
    with pytest.raises(Exception, match="chunk files exist"):
        rgs.rechunk(spark, str(folder / "in"), out)
    assert sorted((p.name, p.stat().st_size) for p in (folder / "again").rglob("*.parquet")) == [b for b in before if b[0].endswith(".parquet")]
    rgs.rechunk(spark, str(folder / "in"), out, mode="overwrite")
    assert not list((folder / "again" / "_temporary").glob("*"))


def test_large_footers_go_to_few_tasks(spark, uneven, monkeypatch):
    folder, sizes, _ = uneven
    monkeypatch.setattr(rgs, "LARGE_FOOTER", 8)
    monkeypatch.setattr(rgs, "FOOTER_TASKS", 2)
    monkeypatch.setattr(rgs, "LARGE_FOOTER_BYTES", 600)
    runs = rgs.plan_runs(str(folder / "in"), 2, None)
    assert [[(c.first, c.stop) for c in r.chunks] for r in runs if "a_2020" in r.chunks[0].path] == [
        [(0, 2), (2, 4), (4, 6)], [(6, 8), (8, 10), (10, 11)]]
    capped = rgs.plan_runs(str(folder / "in"), 2, 5)
    assert [len(r.chunks) for r in capped if "a_2020" in r.chunks[0].path] == [3]
    reader = rgs.RowGroupReader({"path": str(folder / "in"), "groups_per_chunk": "2"}, ["id"])
    got = [(b.column("file_name")[0].as_py(), b.num_rows) for r in runs for b in reader.read(r)]
    assert sum(n for _, n in got) == sum(sum(sizes[n]) for n in ("a_2020.parquet", "2021/x.parquet", "2021/y.parquet"))
    assert len({n for n, _ in got}) == 9
