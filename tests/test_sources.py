import gzip
import json
from types import SimpleNamespace

import pytest

from clearwell.session import MB, folder_bytes, initial_partitions, shared_folder, widen_shuffles, widened_shuffles, write_piece_bytes
from clearwell.sources import readers

ROWS = [{"id": n, "name": f"n{n}"} for n in range(3)]


@pytest.fixture
def landing(tmp_path):
    lines = "\n".join(json.dumps(r) for r in ROWS)
    csv = "id,name\n" + "\n".join(f"{r['id']},{r['name']}" for r in ROWS) + "\n"
    (tmp_path / "a.jsonl").write_text(lines)
    (tmp_path / "b.json").write_text(json.dumps(ROWS, indent=2))
    (tmp_path / "c.csv").write_text(csv)
    (tmp_path / "D.CSV.GZ").write_bytes(gzip.compress(csv.encode()))
    (tmp_path / "e.csv").write_text("")
    return tmp_path


def _pairs(df):
    return sorted((int(r["id"]), r["name"]) for r in df.collect())


WANTED = [(0, "n0"), (1, "n1"), (2, "n2")]


@pytest.mark.parametrize("mode", ["infer", "text"])
@pytest.mark.parametrize(("fmt", "times"), [("csv", 2), ("json", 1), ("jsonl", 1)])
def test_each_format_by_its_name_pattern(spark, landing, fmt, times, mode):
    only = readers.name_glob(fmt)
    df = readers.read_source(spark, str(landing), fmt, mode=mode, pathGlobFilter=only)
    assert _pairs(df) == sorted(WANTED * times)
    assert dict(df.dtypes)["id"] == ("string" if mode == "text" else {"csv": "int"}.get(fmt, "bigint"))


def test_text_keeps_the_written_form(spark, tmp_path):
    (tmp_path / "x.csv").write_text("id,name\n007,a\n")
    path = str(tmp_path / "x.csv")
    assert readers.read_source(spark, path, "csv").first()["id"] == 7
    assert readers.read_source(spark, path, "csv", mode="text").first()["id"] == "007"
    assert readers.read_source(spark, path, "csv", mode="text", columns=("id", "name")).first()["id"] == "007"


def test_csv_with_other_columns_is_refused(spark, tmp_path):
    (tmp_path / "x.csv").write_text("name,id\na,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_source(spark, str(tmp_path), "csv", mode="text", columns=("id", "name")).collect()


def test_corrupt_rows_are_kept(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"id": 1, "name": "a"}\n{oops\n')
    df = readers.read_source(spark, str(tmp_path), "jsonl", mode="text", columns=("id", "name"), keep_corrupt=True)
    assert sorted((r["id"] or "", r["_corrupt_record"] or "") for r in df.cache().collect()) == [("", "{oops"), ("1", "")]
    with pytest.raises(ValueError, match="column names"):
        readers.read_source(spark, str(tmp_path), "jsonl", keep_corrupt=True)


def test_parquet_and_unknown_formats(spark, tmp_path):
    spark.createDataFrame(ROWS).write.parquet(f"{tmp_path}/p")
    assert _pairs(readers.read_source(spark, f"{tmp_path}/p", "parquet")) == WANTED
    with pytest.raises(ValueError, match="unsupported format 'xml'"):
        readers.read_source(spark, str(tmp_path), "xml")
    with pytest.raises(ValueError, match="mode"):
        readers.read_source(spark, str(tmp_path), "csv", mode="guess")


def test_spread(spark, landing):
    df = readers.read_source(spark, str(landing), "csv", pathGlobFilter=readers.name_glob("csv"), spread=5)
    assert df.rdd.getNumPartitions() == 5


def test_listing(spark, landing):
    files = {r["original_key"].rsplit("/", 1)[1]: r["size"] for r in readers.list_uploads(spark, str(landing)).collect()}
    assert set(files) == {"a.jsonl", "b.json", "c.csv", "D.CSV.GZ"}
    assert files["a.jsonl"] == (landing / "a.jsonl").stat().st_size
    assert folder_bytes(spark, str(landing)) == sum(files.values())
    assert readers.preview(readers.list_uploads(spark, str(landing)), 2).count() == 2


def test_shuffles_grow_with_the_input(spark):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert initial_partitions(1) == 1
    assert initial_partitions(10 * 2**30) == 240
    assert initial_partitions(10**17, most=100_000) == 100_000 < initial_partitions(10**17)
    before = spark.conf.get(key, None)
    with widened_shuffles(spark, 10 * 2**30):
        assert spark.conf.get(key) == "240"
    assert spark.conf.get(key, None) == before
    # The size of a scan's splits changes on request only.
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    with widened_shuffles(spark, 10**14):
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == split
        widen_shuffles(spark, 10**14, most=5000, scan_split_bytes=256 * 2**20)
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == str(256 * 2**20)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == split
    with widened_shuffles(spark, 1):
        assert spark.conf.get(key, None) == before


def test_pieces_of_a_write(spark):
    sizes = [write_piece_bytes(spark, n) for n in (None, 1, 320 * MB, 10**14)]
    assert sizes == [128 * MB, 16 * 1024, 60 * MB, 256 * MB]


def test_shared_folder_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    one, two = shared_folder(spark, "a"), shared_folder(spark, "a")
    assert one != two
    if root:
        assert one.startswith(root)


def _session(master):
    conf = SimpleNamespace(get=lambda key, default=None: default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_only_local_sessions_may_do_without_a_shared_folder():
    assert shared_folder(_session("local[2]"), "x") != shared_folder(_session("local[2]"), "x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(_session("yarn"), "x")
