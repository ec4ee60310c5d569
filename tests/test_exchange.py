"""Reading what a list names, writing files by name, and delivering commands: on real folders, with failures."""

import bz2
import json
import os

import pytest
from pyspark.sql import functions as F

from quirelens import filesystem
from quirelens.operators import numbering, sampling
from quirelens.sinks import delivery, named
from quirelens.sources import listed, records


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(bz2.compress(text.encode()) if path.name.endswith(".bz2") else text.encode())


def rows(frame, *names):
    return sorted(tuple(r[n] for n in names) for r in frame.select(*names).collect())


@pytest.fixture()
def folder(tmp_path):
    root = tmp_path / "files"
    for k in range(30):
        put(root / f"f{k % 3}" / f"n {k:02d}+é.json.bz2", json.dumps({"k": k}))
    return root


@pytest.mark.parametrize("slice_bytes", [1, 100, 1 << 20])
def test_only_listed_files_are_opened(spark, folder, tmp_path, slice_bytes):
    wanted = [f"f{k % 3}/n {k:02d}+é.json.bz2" for k in range(0, 30, 3)]
    (tmp_path / "list").mkdir()
    (tmp_path / "list" / "a.txt").write_text("\n".join(wanted[:6]) + "\n\n")
    (tmp_path / "list" / "b.txt").write_text("\n".join("/" + w for w in wanted[4:]))  # some twice, with a leading slash
    for k in range(30):  # what is not listed cannot be read: not as text, and not at all
        if k % 3:
            path = folder / f"f{k % 3}" / f"n {k:02d}+é.json.bz2"
            path.write_bytes(b"not compressed")
            path.chmod(0)
    got = listed.read_listed(spark, str(tmp_path / "list"), str(folder), slice_bytes=slice_bytes)
    assert rows(got, "path", "json") == sorted((w, json.dumps({"k": 3 * i})) for i, w in enumerate(wanted))
    if slice_bytes == 1:
        assert got.rdd.getNumPartitions() > 100  # a file is far more than a byte: slices between stay empty


def test_every_core_gets_a_slice_of_a_short_list(spark, folder, tmp_path):
    wanted = [f"f{k % 3}/n {k:02d}+é.json.bz2" for k in range(30)]
    put(folder / "empty.json", "")  # has no bytes, and lies behind the last slice or in it
    (tmp_path / "list.txt").write_text("\n".join([*wanted, "empty.json"]))
    got = listed.read_listed(spark, str(tmp_path / "list.txt"), str(folder))
    assert rows(got, "path", "json") == sorted([*((w, json.dumps({"k": k})) for k, w in enumerate(wanted)), ("empty.json", "")])
    cores = spark.sparkContext.defaultParallelism
    assert min(15, cores) <= got.rdd.getNumPartitions() <= listed.SLICES_PER_CORE * cores
    (tmp_path / "list.txt").write_text("empty.json\n")
    assert rows(listed.read_listed(spark, str(tmp_path / "list.txt"), str(folder)), "path", "json") == [("empty.json", "")]


def test_opened_files_are_the_listed_ones(spark, folder, tmp_path):
    (tmp_path / "list.txt").write_text("f0/n 00+é.json.bz2\nf1/n 01+é.json.bz2\n")
    log = tmp_path / "log"
    log.mkdir()

    def read(uri):
        (log / os.path.basename(uri)).write_text("")
        return filesystem.read_bytes(uri)

    assert listed.read_listed(spark, str(tmp_path / "list.txt"), "file://" + str(folder), read=read).count() == 2
    assert sorted(os.listdir(log)) == ["n 00+é.json.bz2", "n 01+é.json.bz2"]


def test_missing_and_damaged_files(spark, folder, tmp_path):
    (tmp_path / "list.txt").write_text("f0/n 00+é.json.bz2\nf9/none.json.bz2\n")
    with pytest.raises(Exception, match="listed file not found: f9/none.json.bz2"):
        listed.read_listed(spark, str(tmp_path / "list.txt"), str(folder)).collect()
    assert listed.read_listed(spark, str(tmp_path / "list.txt"), str(folder), strict=False).count() == 1
    (folder / "f0" / "n 00+é.json.bz2").write_bytes(b"broken")
    with pytest.raises(Exception):
        listed.read_listed(spark, str(tmp_path / "list.txt"), str(folder), strict=False).collect()
    (tmp_path / "list.txt").write_text("\n")
    assert listed.read_listed(spark, str(tmp_path / "list.txt"), str(folder)).count() == 0


def test_both_readers_agree(spark, folder, tmp_path):
    (tmp_path / "list.txt").write_text("".join(f"f{k % 3}/n {k:02d}+é.json.bz2\n" for k in range(0, 30, 2)))
    args = (spark, str(tmp_path / "list.txt"), str(folder))
    assert rows(listed.read_listed(*args), "path", "json") == rows(records.scan_filelist(*args), "path", "json")


def test_named_files_are_read_back(spark, tmp_path):
    made = [(f"a/b{k % 4}/page-{k:03d}.json.bz2", json.dumps({"text": "é" * k})) for k in range(50)] + [("plain.json", "{}")]
    frame = spark.createDataFrame(made, "path string, json string").repartition(4)
    lists = named.write_named(frame, str(tmp_path / "out"))
    assert rows(listed.read_listed(spark, lists, str(tmp_path / "out")), "path", "json") == sorted(made)
    assert bz2.decompress((tmp_path / "out" / "a/b1/page-001.json.bz2").read_bytes()) == '{"text": "é"}'.replace("é", "\\u00e9").encode()
    left = [f for _, _, names in os.walk(tmp_path / "out") for f in names if f.startswith(".") and not f.endswith(".crc")]
    assert left == []


def test_unfinished_write_names_no_files(spark, tmp_path):
    frame = spark.range(40).select(F.concat(F.lit("f"), "id").alias("path"), F.when(F.col("id") == 39, F.raise_error(F.lit("lost"))).otherwise("{}").alias("json"))
    with pytest.raises(Exception, match="lost"):
        named.write_named(frame.repartition(1), str(tmp_path / "out"))
    assert not (tmp_path / "out" / named.LISTED).exists()


URLS = ["http://one/update", "http://two/update", "http://three/update"]


def commands(spark, n, turn=0):
    made = [(f"d{k}", json.dumps({"id": f"d{k}", "turn": turn}), URLS) for k in range(n)]
    return spark.createDataFrame(made, "doc_id string, json string, endpoints array<string>").repartition(4)


def poster(log, refuse):
    """Writes down every call; ``refuse`` says what an endpoint does with a document."""

    def post(endpoint, body):
        doc = json.loads(body)["id"]
        with open(os.path.join(log, f"{os.getpid()}"), "a") as f:
            f.write(f"{endpoint} {doc}\n")
        answer = refuse(endpoint, doc)
        if isinstance(answer, Exception):
            raise answer
        return not answer

    return post


def calls(log):
    return sorted(line for name in os.listdir(log) for line in (log / name).read_text().splitlines())


def test_refusing_endpoints_are_passed_over(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    answers = {"d1": 1, "d2": 2, "d3": 3}  # so many endpoints refuse, the second by an error

    def refuse(endpoint, doc):
        k = URLS.index(endpoint)
        return (OSError("down") if k == 1 else True) if k < answers.get(doc, 0) else False

    got = delivery.deliver(commands(spark, 10), poster(str(log), refuse), str(tmp_path / "state"), pause=(0, 0))
    want = {f"d{k}": (URLS[0], 1) for k in range(10)} | {"d1": (URLS[1], 2), "d2": (URLS[2], 3), "d3": (None, 3)}
    assert {r.doc_id: (r.endpoint, r.attempts) for r in got.collect()} == want
    assert len(calls(log)) == 10 + 1 + 2 + 2


def test_delivered_commands_are_not_sent_again(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    down = poster(str(log), lambda endpoint, doc: doc in ("d4", "d5"))
    state = str(tmp_path / "state")
    delivery.deliver(commands(spark, 8), down, state, pause=(0, 0))
    before = calls(log)
    # the refused two are tried again, with another partitioning; the others are not
    got = delivery.deliver(commands(spark, 8).repartition(2), poster(str(log), lambda e, d: False), state, pause=(0, 0))
    new = list(calls(log))
    for line in before:
        new.remove(line)
    assert new == [f"{URLS[0]} d4", f"{URLS[0]} d5"]
    assert all(r.endpoint for r in got.collect()) and got.count() == 8
    # a changed document is another command
    got = delivery.deliver(commands(spark, 2, turn=1), poster(str(log), lambda e, d: False), state, pause=(0, 0))
    assert got.count() == 10
    assert len(os.listdir(os.path.join(state, delivery.DONE))) == 3


class Stop(Exception):
    pass


def test_a_task_that_runs_again_sends_nothing_twice(tmp_path, monkeypatch):
    """The writer itself: an attempt that dies, and the one that follows on the same partition."""

    class Context:
        def __init__(self, attempt):
            self.attempt = attempt

        def partitionId(self):
            return 3

        def taskAttemptId(self):
            return self.attempt

    sent = []
    work = [{"doc_id": f"d{k}", "json": f"{{{k}}}", "endpoints": URLS} for k in range(10)]

    def dying(limit):
        for k, row in enumerate(work):
            if k == limit:
                raise Stop
            yield row

    writer = delivery.DeliveryWriter(lambda e, body: sent.append(body) is None, str(tmp_path), "run", (0, 0), 3)
    monkeypatch.setattr(delivery.TaskContext, "get", classmethod(lambda cls: Context(0)))
    with pytest.raises(Stop):
        writer.write(dying(7))
    monkeypatch.setattr(delivery.TaskContext, "get", classmethod(lambda cls: Context(1)))
    message = writer.write(iter(work))
    assert (message.posted, message.known) == (3, 7)
    assert sorted(sent) == sorted(r["json"] for r in work)  # each once
    # and a third, after all is done, as when a result is lost
    assert writer.write(iter(work)).known == 10 and len(sent) == 10
    writer.commit([message, None])
    assert json.loads((tmp_path / delivery.DONE / "run.json").read_text()) == {"posted": 3, "refused": 0, "known": 7}


def test_positions_in_order(spark):
    made = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x"), F.lit("y").alias("y")).repartition(7)
    got = numbering.running_total(made, ["x"], name="at")
    assert rows(got, "x", "at") == [(k, k) for k in range(1000)]
    weighed = numbering.running_total(made, ["x"], F.col("x"))
    assert rows(weighed, "x", "before") == [(k, k * (k - 1) // 2) for k in range(1000)]
    assert rows(sampling.every_n(made, ["x"], 300), "x", "position") == [(0, 0), (300, 300), (600, 600), (900, 900)]
    ties = spark.createDataFrame([("a",)] * 5 + [("b",)] * 5 + [(None,)] * 2, "k string")
    assert sorted(r.before for r in numbering.running_total(ties, ["k"]).collect()) == list(range(12))
    assert numbering.running_total(made.filter("x < 0"), ["x"]).count() == 0


def test_numbering_needs_no_python_and_no_single_task(spark):
    plan = numbering.running_total(spark.range(100).selectExpr("id AS x"), ["x"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Python" not in plan and "Arrow" not in plan


def test_file_list_names_every_volume(spark, tmp_path):
    from quirelens.plans.exchange import src_filelist

    made = [(k, f"one two three\nword{k} and more.", lang, "web", 30) for k, lang in enumerate(["en", "de", "fr", None, "es"])]
    spark.createDataFrame(made, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    assert src_filelist(spark, str(tmp_path)).count() == 5


def test_files_are_written_out_of_batches(spark, tmp_path):
    """A batch's texts do not all stand in memory as Python objects."""
    import pyarrow as pa

    assert issubclass(named.NamedFilesWriter, named.DataSourceArrowWriter)
    made = [(f"f{k}.json", "é" * k) for k in range(5)]
    lists = named.write_named(spark.createDataFrame(made, "path string, json string").repartition(1), str(tmp_path / "out"))
    assert rows(listed.read_listed(spark, lists, str(tmp_path / "out")), "path", "json") == made
    assert pa.array(["é"]).cast(pa.binary())[0].as_py() == "é".encode()


def test_commands_come_in_batches_and_a_journal_is_read_by_folder(spark, tmp_path):
    """A row for each command was pickled, and each segment of a hundred commands was a file that the driver listed."""
    state = str(tmp_path / "state")
    sink = delivery.delivery_sink(lambda e, body: True, state, "run", (0, 0), 2)
    assert issubclass(type(sink({}).writer(None, False)), named.DataSourceArrowWriter)
    got = delivery.deliver(commands(spark, 200), lambda e, body: json.loads(body)["id"] != "d7", state, pause=(0, 0), hold=2)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "FileScan" not in plan and "Scan json" not in plan
    assert sum(len(names) for _, _, names in os.walk(os.path.join(state, delivery.JOURNAL))) >= 100
    want = {f"d{k}": (URLS[0], 1) for k in range(200)} | {"d7": (None, 3)}
    assert {r.doc_id: (r.endpoint, r.attempts) for r in got.collect()} == want
    assert filesystem.folders(str(tmp_path / "nowhere")) == [] and filesystem.folders(f"file://{state}") == [delivery.DONE, delivery.JOURNAL]


def test_an_empty_delivery_has_no_outcomes(spark, tmp_path):
    got = delivery.deliver(commands(spark, 3).filter("doc_id = ''"), lambda e, body: True, str(tmp_path / "state"), pause=(0, 0))
    assert got.columns == ["doc_id", "digest", "endpoint", "attempts"] and got.collect() == []


def test_a_text_is_packed_as_one_block_and_its_folder_is_made_once(spark, tmp_path, monkeypatch):
    for n in (0, 3, 2_000, 79_000, 99_000, 250_000, 1_200_000):
        data = b"".join(b"aaaa%d" % k for k in range(n // 7))[:n]
        packed = named.compressed(data)
        assert bz2.decompress(packed) == data
        assert packed[4:] == bz2.compress(data)[4:]  # but for the size of the block that the head names
    assert named.compressed(b"{}" * 1000)[:4] == b"BZh1" and named.compressed(b"x" * 1_200_000)[:4] == b"BZh9"

    import pyarrow as pa

    class Context:
        def partitionId(self):
            return 0

        taskAttemptId = partitionId

    there, publish = [], filesystem.publish
    monkeypatch.setattr(named.TaskContext, "get", classmethod(lambda cls: Context()))
    monkeypatch.setattr(named.filesystem, "publish", lambda uri, data, there_=False, **k: (there.append(k.get("there", False)), publish(uri, data, **k)))
    paths = ["a/b/1.json.bz2", "a/b/2.json.bz2", "a/c/1.json.bz2", "a/b/3.json", "top.json"]
    message = named.NamedFilesWriter(str(tmp_path)).write(iter([pa.RecordBatch.from_arrays([pa.array(paths), pa.array(["{}"] * 5)], ["path", "json"])]))
    assert (message.n, there) == (5, [False, True, False, False, False, False])
    assert all((tmp_path / p).exists() for p in paths)
