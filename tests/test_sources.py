"""Files in, snapshots, registry versions, streams over several triggers."""

import tempfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from claimweave import fixed
from claimweave.operators import ingest, registry
from claimweave.sources import snapshots, stores, transcripts
from claimweave.streaming import registry as registry_stream
from claimweave.streaming import transcripts as transcript_stream


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def write_transcripts(folder, n=5, each=40):
    Path(folder, "in").mkdir()
    for e in range(n):
        out = []
        for i in range(each):
            out.append(f"S{i % 2} | 00:{i:02d}:00 | 00:{i:02d}:{30 if i % 7 else 0:02d} | said {i} in {e}. And more.")
            if i % 3 == 2:
                out.append("")
        Path(folder, "in", f"ep_{e}.txt").write_text("\r\n".join(out) + "\r\n" if e % 2 else "\n".join(out), encoding="utf-8")


def key(df):
    return sorted(map(tuple, df.select("episode_id", "line_no", "line").collect()))


def test_split_reading_numbers_lines_like_whole_files(spark, folder):
    write_transcripts(folder)
    whole = transcripts.read_whole_files(spark, f"{folder}/in")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        cut = transcripts.read_lines(spark, f"{folder}/in")
        got = key(cut.filter(F.length(F.trim("line")) > 0))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == key(whole.filter(F.length(F.trim("line")) > 0))
    assert max(n for e, n, _ in got if e == "ep_0") == 40 + 13  # texts and blank lines


def test_equal_stems_and_bad_names_are_refused(spark, folder):
    for place in ("x", "y"):
        Path(folder, "in", place).mkdir(parents=True)
        Path(folder, "in", place, "ep1.txt").write_text("A | 00:00:01 | 00:00:02 | hi")
    with pytest.raises(ValueError, match="one episode id"):
        transcripts.read_lines(spark, f"{folder}/in")
    assert transcripts.read_lines(spark, f"{folder}/in/x").count() == 1
    Path(folder, "in", "x", "ep 2.txt").write_text("A | 00:00:01 | 00:00:02 | hi")
    with pytest.raises(ValueError, match="no episode id"):
        transcripts.read_whole_files(spark, f"{folder}/in/x")


def test_phases_are_saved_and_the_registry_is_rebuilt_from_them(spark, folder):
    from claimweave.plans.conversation import Conversations
    from claimweave.sources import tables

    lines = tables.transcript_lines(tables.table(spark, "/root/testdata/sf0.001", "conversations"))
    c = Conversations(lines, tables.responses, keep=True)
    c.save(f"{folder}/phases", "one", "2024-01-01")
    saved = {r["phase"] for r in snapshots.manifest(spark, f"{folder}/phases").select("phase").distinct().collect()}
    assert saved == set(fixed.PHASES)
    assert registry_stream.rebuild(spark, f"{folder}/registry", f"{folder}/nothing") is None
    assert registry_stream.rebuild(spark, f"{folder}/registry", f"{folder}/phases") == 0
    assert stores.load_registry(spark, f"{folder}/registry")["canonical"].count() == c.canonicals.count()


@pytest.mark.parametrize("phase, kept", [("model", 1), ("clusters", 3)])
def test_a_run_that_breaks_off_keeps_the_phases_before(spark, folder, monkeypatch, phase, kept):
    from claimweave.plans import conversation
    from claimweave.sources import tables

    def breaks(*_):
        raise InterruptedError

    if phase == "clusters":
        monkeypatch.setattr(conversation.cluster, "link_clusters", breaks)
    lines = tables.transcript_lines(tables.table(spark, "/root/testdata/sf0.001", "conversations"))
    c = conversation.Conversations(lines, breaks if phase == "model" else tables.responses, keep=True)
    with pytest.raises(InterruptedError):
        c.save(folder, "one", "2024-01-01")
    m = snapshots.manifest(spark, folder)
    assert {r["phase"] for r in m.select("phase").distinct().collect()} == set(fixed.PHASES[:kept])
    following = {r["next_phase"] for r in snapshots.resume_points(m, c.episodes).collect()}
    assert fixed.PHASES[kept] in following


def test_episodes_are_numbered_without_gaps(spark, folder):
    write_transcripts(folder)
    rows = ingest.number_episodes(transcripts.read_lines(spark, f"{folder}/in")).select("episode_id", "episode_seq").distinct().collect()
    assert sorted(map(tuple, rows)) == [(f"ep_{i}", i) for i in range(5)]


def test_stream_over_triggers_and_restart_equals_batch(spark, folder):
    write_transcripts(folder)
    lines = lambda: transcripts.stream_lines(spark, f"{folder}/in", 2)
    transcript_stream.ingest_stream(lines(), f"{folder}/out", f"{folder}/state").awaitTermination()
    Path(folder, "in", "late.txt").write_text("S | 00:00:01 | 00:00:02 | late\nbroken", encoding="utf-8")
    transcript_stream.ingest_stream(lines(), f"{folder}/out", f"{folder}/state").awaitTermination()
    parsed = ingest.parse_lines(transcripts.read_whole_files(spark, f"{folder}/in").withColumn("episode_seq", F.lit(None).cast("bigint")))
    for name, want in (("utterances", ingest.accepted(parsed)), ("rejects", ingest.rejected(parsed))):
        got = spark.read.parquet(f"{folder}/out/{name}").drop("batch")
        cols = [c for c in want.columns if c not in ("episode_seq", "audio_snippet_uri")]
        assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))


def test_snapshots_latest_resume_and_delete(spark, folder):
    def rows(*pairs):
        return spark.createDataFrame(pairs, "episode_id string, x bigint")

    assert snapshots.load(spark, folder, "utterances") is None
    snapshots.save(rows(("a", 1), ("b", 1)), folder, "utterances", "001", "2024-01-01")
    snapshots.save(rows(("a", 2), ("a", 3)), folder, "utterances", "002", "2024-01-02")
    snapshots.save(rows(("a", 9)), folder, "beliefs_raw", "002", "2024-01-02")
    assert sorted(map(tuple, snapshots.load(spark, folder, "utterances").select("episode_id", "x").collect())) == [("a", 2), ("a", 3), ("b", 1)]
    m, eps = snapshots.manifest(spark, folder), spark.createDataFrame([("a",), ("b",), ("c",)], "episode_id string")
    points = {r["episode_id"]: (r["last_phase"], r["next_phase"]) for r in snapshots.resume_points(m, eps).collect()}
    assert points == {"a": ("beliefs_raw", "canonical_beliefs"), "b": ("utterances", "beliefs_raw"), "c": (None, "utterances")}
    assert snapshots.expired(m, "2024-03-01", 0).count() == 0
    old = snapshots.expired(m, "2024-01-31 12:00:00", 30)
    assert [r["episode_id"] for r in old.collect()] == ["b"]
    snapshots.delete(spark, folder, old, "x")
    assert {r["episode_id"] for r in snapshots.load(spark, folder, "utterances").collect()} == {"a"}
    with pytest.raises(ValueError):
        snapshots.save(rows(("a", 1)), folder, "nonsense", "003", "2024-01-01")


MENTIONS = (
    "belief_id string, utterance_id string, belief_text string, original_quote string, norm_text string, canonical_id string, "
    "episode_id string, episode_seq bigint, speaker string"
)


def test_registry_merge_is_idempotent_and_half_versions_are_unseen(spark, folder):
    m = spark.createDataFrame(
        [("b1", "u1", "X", "q", "x", "c1", "e0", 0, "S"), ("b2", "u2", "x", "q", "x", "c1", "e1", 1, "S"), ("b3", "u3", "Y", "q", "y", "c2", "e1", 1, "T")],
        MENTIONS,
    )
    once = registry_stream.merge_batch(stores.empty_registry(spark), m)
    stores.save_registry(once, folder, 0)
    back = stores.load_registry(spark, folder)
    twice = registry_stream.merge_batch(back, m)
    for name in once:
        assert sorted(map(str, back[name].collect())) == sorted(map(str, twice[name].select(back[name].columns).collect())), name
    once["alias"].write.parquet(f"{folder}/version=1/alias")  # a writer that died before its pointer
    assert stores.registry_version(spark, folder) == 0
    assert stores.load_registry(spark, folder + "/nothing")["alias"].count() == 0


def test_what_a_batch_writes_follows_the_batch(spark, folder):
    """Parts shrink by half at least, together they are the registry of one merge, and replays add nothing."""
    rows = [(f"b{i}", f"u{i}", f"T{i % 9}", "q", "t", f"c{i % 9}", f"e{i // 4}", i // 4, "S") for i in range(76)]
    batches = [rows[:64], *[rows[i : i + 4] for i in range(64, 76, 4)]]
    for i, batch in enumerate(batches):
        registry_stream.write_batch(spark.createDataFrame(batch, MENTIONS), i, folder, "one")
        version = stores.registry_version(spark, folder)
        sizes = [size for _, size in stores.registry_parts(spark, folder, version)]
        assert all(a > 2 * b for a, b in zip(sizes, sizes[1:])) and sizes[0] == 64 and sum(sizes) == 64 + 4 * i
        written = [spark.read.parquet(f"{folder}/version={version}/{name}").count() for name in stores.REGISTRY]
        assert i == 0 or max(written) <= 20
    registry_stream.write_batch(spark.createDataFrame(batches[2], MENTIONS), 2, folder, "one")
    assert stores.registry_version(spark, folder) == version
    registry_stream.write_batch(spark.createDataFrame(batches[2], MENTIONS), 0, folder, "two")
    got = stores.load_registry(spark, folder)
    want = registry_stream.merge_batch(stores.empty_registry(spark), spark.createDataFrame(rows, MENTIONS))
    for name in want:
        assert sorted(map(str, got[name].collect())) == sorted(map(str, want[name].select(got[name].columns).collect())), name


def test_a_long_streamed_file_is_read_by_many_tasks(spark, folder):
    """Splits of 4,000 bytes, one file of several hundred thousand: every line has its number, over two triggers."""
    Path(folder, "in").mkdir()
    texts = {"long": [f"S{i % 3} | 00:00:00 | 00:00:01 | word {i}" for i in range(9000)], "short": ["A | 00:00:00 | 00:00:01 | hi"] * 3}
    for name, lines in texts.items():
        Path(folder, "in", f"{name}.txt").write_text("\n".join(lines) + "\n")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k, v in zip(kept, ("4000", "1")):
            spark.conf.set(k, v)
        assert spark.read.text(f"{folder}/in").rdd.getNumPartitions() > 50
        lines = transcripts.stream_lines(spark, f"{folder}/in", 1)
        transcript_stream.ingest_stream(lines, f"{folder}/out", f"{folder}/state").awaitTermination()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    rows = spark.read.parquet(f"{folder}/out/utterances").select("episode_id", "line_no", "text", "batch").collect()
    assert len({r["batch"] for r in rows}) == 2
    got = {(r["episode_id"], r["line_no"], r["text"]) for r in rows}
    assert len(rows) == 9003 and got == {(n, i, x.split(" | ")[3]) for n, xs in texts.items() for i, x in enumerate(xs, 1)}


def test_registry_lookups(spark):
    alias = spark.createDataFrame([("x", "c1", 1)], "alias_text string, canonical_id string, seq bigint")
    newer = registry.upsert_aliases(alias, spark.createDataFrame([("x", "c2", 2), ("y", "c3", 0)], alias.schema))
    asked = spark.createDataFrame([("b1", "X"), ("b2", "z")], "belief_id string, belief_text string")
    got = {r["belief_id"]: r["alias_canonical_id"] for r in registry.find_by_text(asked, newer).collect()}
    assert got == {"b1": "c2", "b2": None}


def test_reports_of_unknown_episode_are_empty(spark, folder):
    assert stores.load_reports(spark, f"{folder}/none", "x").count() == 0


@pytest.mark.parametrize("stop", ["before the data", "half of the data", "before old versions go", "none"])
def test_a_purge_that_stops_loses_nothing(spark, folder, monkeypatch, stop):
    """Wherever a purge stops, kept rows can be read; the next one finishes it."""
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "episode_id string, x bigint")
    for run in ("001", "002"):
        snapshots.save(rows, folder, "utterances", run, f"2024-01-0{run[-1]}")
    snapshots.save(rows, folder, "utterances", "002", "2024-01-02")  # a repeated run takes over
    m = snapshots.manifest(spark, folder)
    snapshots.delete(spark, folder, m.filter("run_id = '001' OR episode_id = 'b'"), "x")

    def kept():
        return sorted(map(tuple, snapshots.load(spark, folder, "utterances").select("episode_id", "x").collect()))

    real_write, real_tidy = snapshots._write_run, snapshots._tidy

    def write(data, where):
        if stop == "half of the data":
            real_write(data, where)
            snapshots._remove(data.sparkSession, f"{where}/_SUCCESS")
        if stop in ("before the data", "half of the data"):
            raise InterruptedError
        real_write(data, where)

    def tidy(session, where):
        if stop == "before old versions go":
            raise InterruptedError
        real_tidy(session, where)

    monkeypatch.setattr(snapshots, "_write_run", write)
    monkeypatch.setattr(snapshots, "_tidy", tidy)
    if stop == "none":
        snapshots.purge(spark, folder)
    else:
        with pytest.raises(InterruptedError):
            snapshots.purge(spark, folder)
    assert kept() == [("a", 1), ("c", 3)]
    monkeypatch.setattr(snapshots, "_write_run", real_write)
    monkeypatch.setattr(snapshots, "_tidy", real_tidy)
    assert snapshots.purge(spark, folder) == 2
    assert kept() == [("a", 1), ("c", 3)]
    left = spark.read.option("recursiveFileLookup", "true").parquet(f"{folder}/data")
    assert sorted(r["x"] for r in left.collect()) == [1, 3]
    snapshots.purge(spark, folder)
    assert kept() == [("a", 1), ("c", 3)]


def test_triggers_of_streamed_transcripts_do_not_grow_with_the_files(spark, monkeypatch):
    from claimweave.plans import queries

    class Stop(Exception):
        pass

    def stopped(spark, path, files_per_trigger):
        raise Stop(files_per_trigger)

    monkeypatch.setattr(queries.transcripts, "stream_lines", stopped)
    for n, many in ((3, 50), (1100, 55)):
        given = queries.Inputs(spark, "")
        rows = spark.range(n).select(F.col("id").alias("conv_id"), F.lit(0).cast("long").alias("turn"), F.lit("user").alias("role"), F.lit("Hi.").alias("text"))
        monkeypatch.setattr(queries.Inputs, "table", lambda self, name, rows=rows: rows)
        with pytest.raises(Stop) as stop:
            queries.QUERIES["m1_streamed_utterances"].__closure__[0].cell_contents(given)
        assert stop.value.args == (many,)
