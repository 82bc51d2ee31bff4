"""Every operator as a query over the given tables.

All of them read whole tables.  Operators that need transcripts, model answers,
call logs or registries get them from ``sources.tables``, which derives them from
the given tables inside the same Spark plan.
"""

from __future__ import annotations

import uuid
from functools import cached_property

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave import fixed

from claimweave.functions.ids import content_id, hash16
from claimweave.functions.ordered import blocks
from claimweave.functions.text import norm_tokens, strip
from claimweave.operators import (
    calls,
    canonical,
    cluster,
    contracts,
    contradict,
    drift,
    extract,
    ingest,
    matrix,
    ontology,
    previews,
    quality,
    registry,
    similar,
    split,
)
from claimweave.operators.groups import with_singletons
from claimweave.params import Params
from claimweave.plans.conversation import Conversations, quality_events, quality_reports
from claimweave.session import durable, shared_dir, tune, written
from claimweave.sources import snapshots, stores, tables, transcripts
from claimweave.streaming import calls as call_streams
from claimweave.streaming import registry as registry_streams
from claimweave.streaming import transcripts as transcript_streams

PARAMS = Params(synonyms={"une": "un", "les": "le"}, budget_window_s=21600, budget_requests=2, budget_tokens=3000)
RUN_DATE = "2024-01-01"
AS_OF = "2024-02-20 00:00:00"

QUERIES: dict[str, object] = {}


def query(f):
    QUERIES[f.__name__] = lambda spark, folder: f(Inputs(tune(spark), folder))
    return f


class Inputs:
    """The given tables of one folder and what is derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return tables.table(self.spark, self.folder, name)

    @property
    def lines(self) -> DataFrame:
        return tables.transcript_lines(self.table("conversations"))

    @cached_property
    def chain(self) -> Conversations:
        return Conversations(self.lines, tables.responses, PARAMS, RUN_DATE)

    @cached_property
    def kept(self) -> Conversations:
        """The same with the mentions written once, for queries that read them several times."""
        return Conversations(self.lines, tables.responses, PARAMS, RUN_DATE, keep=True)

    @property
    def calls(self) -> DataFrame:
        return tables.calls(self.table("events"))

    def scratch(self) -> str:
        return f"{shared_dir(self.spark)}/claimweave-{uuid.uuid4().hex}"

    def halves(self, mentions: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Mentions of the first half of the episodes, and of the rest."""
        middle = self.table("conversations").agg(F.floor(F.max("conv_id") / 2)).scalar()
        return mentions.filter(F.col("episode_seq") <= middle), mentions.filter(F.col("episode_seq") > middle)

    @property
    def manifest(self) -> DataFrame:
        """Snapshots of every episode; some episodes have not run all phases."""
        phases = F.array(*[F.struct(F.lit(p).alias("phase"), F.lit(i).alias("ord")) for i, p in enumerate(fixed.PHASES)])
        rows = self.table("conversations").groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"))
        reached = (F.col("conv_id") * 7) % 5
        return (
            rows.select("conv_id", "turns", F.explode(phases).alias("p"))
            .filter(F.col("p.ord") < reached)
            .select(
                tables.episode_name(F.col("conv_id")).alias("episode_id"),
                F.col("p.phase").alias("phase"),
                F.concat(F.lit("run"), F.col("p.ord").cast("string")).alias("run_id"),
                F.timestamp_seconds(
                    F.lit(1704067200) + F.col("conv_id") * 40000 + F.col("p.ord") * (60 + F.col("conv_id") % 7)
                ).alias("ts"),
                (F.col("turns") * (F.col("p.ord") + 1)).cast("bigint").alias("row_count"),
            )
        )


def r6(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def join_list(c: Column | str) -> Column:
    return F.array_join(c, ",")


# --- A: sources and sinks -----------------------------------------------------------


@query
def a1_file_lines(t: Inputs) -> DataFrame:
    """Documents taken as transcript files: numbered, stripped, non-empty lines."""
    files = t.table("documents").select(
        F.col("text").alias("value"), F.concat(F.lit("/in/doc_"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("transcript_path")
    )
    lines = transcripts.explode_files(files).withColumn("line", strip(F.col("line"))).filter(F.length("line") > 0)
    return lines.select("episode_id", "line_no", F.md5("line").alias("line_md5"))


@query
def a1_transcript_lines(t: Inputs) -> DataFrame:
    return t.lines


@query
def a2_episodes(t: Inputs) -> DataFrame:
    e = t.chain.episodes
    return e.select("episode_id", "episode_seq", "title", F.col("date").cast("string").alias("date"), "transcript_path")


@query
def a2_numbered_episodes(t: Inputs) -> DataFrame:
    """Episodes numbered in the order of their ids."""
    return ingest.number_episodes(t.lines.drop("episode_seq")).select("episode_id", "episode_seq").distinct()


@query
def a3_a4_snapshot_round_trip(t: Inputs) -> DataFrame:
    """Utterances saved as a phase snapshot, saved again by a second run, and loaded."""
    folder, rows = t.scratch(), t.chain.utterances
    snapshots.save(rows, folder, "utterances", "first", "2024-01-01 00:00:00")
    snapshots.save(rows.withColumn("text", F.concat("text", F.lit("!"))), folder, "utterances", "second", "2024-01-02 00:00:00")
    back = snapshots.load(t.spark, folder, "utterances")
    return back.select("utterance_id", "episode_id", "speaker", "start_s", "end_s", F.md5("text").alias("text_md5"))


@query
def a3_smaller_rerun(t: Inputs) -> DataFrame:
    """A run saved with all utterances and again, under its own name, with those of one role."""
    folder, rows = t.scratch(), t.chain.utterances
    snapshots.save(rows, folder, "utterances", "only", "2024-01-01 00:00:00")
    snapshots.save(rows.filter("speaker = 'USER'"), folder, "utterances", "only", "2024-01-02 00:00:00")
    return snapshots.load(t.spark, folder, "utterances").select("utterance_id", "episode_id", "speaker")


@query
def a6_purged(t: Inputs) -> DataFrame:
    """Rows left in the files after the snapshots of the earlier half of the episodes were deleted."""
    folder, rows = t.scratch(), durable(t.chain.utterances)
    snapshots.save(rows, folder, "utterances", "one", "2024-01-01 00:00:00")
    middle = t.table("conversations").agg(F.floor(F.max("conv_id") / 2)).scalar()
    early = rows.filter(F.col("episode_seq") <= middle).select("episode_id").distinct()
    gone = snapshots.manifest(t.spark, folder).join(early, "episode_id", "left_semi")
    snapshots.delete(t.spark, folder, gone, "early")
    snapshots.purge(t.spark, folder)
    return t.spark.read.parquet(f"{folder}/data/phase=utterances").select("utterance_id", "episode_id")


@query
def a5_resume_points(t: Inputs) -> DataFrame:
    return snapshots.resume_points(t.manifest, t.chain.episodes)


@query
def a5_pending(t: Inputs) -> DataFrame:
    return snapshots.pending(t.manifest, t.chain.episodes, "canonical_beliefs").select("episode_id")


@query
def a6_expired(t: Inputs) -> DataFrame:
    return snapshots.expired(t.manifest, AS_OF, PARAMS.retention_days).select("episode_id", "phase", "run_id")


@query
def a7_registry_round_trip(t: Inputs) -> DataFrame:
    """A registry built from all mentions, written as a version and read back."""
    folder = t.scratch()
    built = registry_streams.merge_batch(stores.empty_registry(t.spark), durable(t.kept.mentions))
    stores.save_registry(built, folder, 0)
    back = stores.load_registry(t.spark, folder)
    counted = [df.agg(F.lit(name).alias("part"), F.count(F.lit(1)).alias("n")) for name, df in back.items()]
    out = counted[0]
    for c in counted[1:]:
        out = out.unionByName(c)
    return out


@query
def a8_report_round_trip(t: Inputs) -> DataFrame:
    folder, c = t.scratch(), t.chain
    events = durable(quality_events(c))
    report = quality.reports(quality.counters(events, c.episodes), created="2024-01-01 00:00:00")
    stores.save_reports(quality.full_reports(report, quality.messages(events, PARAMS)), folder, "one")
    back = stores.load_reports(t.spark, folder)
    return back.select(
        "episode_id", "page_no", "errors_count", "quality_score", "quality_grade",
        F.size("parsing_errors").alias("n_parsing"), F.size("api_errors").alias("n_api"), F.size("warnings").alias("n_warnings"),
    )


@query
def a8_second_run(t: Inputs) -> DataFrame:
    """Reports of all episodes, then of the later half by a second run, which adds a parsing error to each."""
    folder, c = t.scratch(), t.chain
    events = durable(quality_events(c))
    middle = t.table("conversations").agg(F.floor(F.max("conv_id") / 2)).scalar()
    late = c.episodes.filter(F.col("episode_seq") > middle)
    more = late.select("episode_id", F.lit("parsing_error").alias("kind"), F.lit(0).cast("bigint").alias("at"), F.lit("again").alias("message"))
    again = events.join(late.select("episode_id"), "episode_id", "left_semi").select("episode_id", "kind", "at", "message").unionByName(more)
    for run, rows, episodes, at in (("one", events, c.episodes, "2024-01-01"), ("two", again, late, "2024-01-02")):
        report = quality.reports(quality.counters(rows, episodes), created=f"{at} 00:00:00")
        stores.save_reports(quality.full_reports(report, quality.messages(rows, PARAMS)), folder, run)
    return stores.load_reports(t.spark, folder).select("episode_id", "page_no", "errors_count", "quality_score")


@query
def a9_matrix_csv(t: Inputs) -> DataFrame:
    """The whole matrix written as CSV files, block by block, and read back in long form."""
    folder, c = t.scratch(), t.chain
    stores.write_csv(matrix.csv_lines(c.episodes, durable(c.cells), PARAMS), folder)
    return stores.read_csv(t.spark, folder).withColumn("conviction_avg", r6("conviction_avg"))


@query
def a10_matrix_json(t: Inputs) -> DataFrame:
    """Nested JSON export, parsed and exploded again."""
    weight = "map<string,struct<conviction_avg:double,frequency:bigint,stability_score:double,presence_flag:boolean>>"
    back = matrix.as_json(t.chain.cells, PARAMS).select("episode_id", F.explode(F.from_json("weights_json", weight)).alias("canonical_id", "w"))
    return back.select(
        "episode_id", "canonical_id", r6("w.conviction_avg").alias("conviction_avg"), "w.frequency",
        r6("w.stability_score").alias("stability_score"), "w.presence_flag",
    )


@query
def a11_contradiction_report(t: Inputs) -> DataFrame:
    """Contradictions with their episodes written as JSON lines and read back."""
    folder, c = t.scratch(), t.kept
    mentions = durable(c.mentions)
    found = durable(contradict.contradictions(c.certain, mentions))
    lists = contradict.episode_lists(contradict.where_held(found, mentions), PARAMS)
    stores.write_json(found.join(lists, "contradiction_id"), folder)
    back = t.spark.read.schema("contradiction_id string, type string, page_no bigint, episode_ids array<string>").json(folder)
    return back.select("contradiction_id", "type", "page_no", join_list(F.array_sort("episode_ids")).alias("episode_ids"))


@query
def a12_belief_preview(t: Inputs) -> DataFrame:
    return previews.belief_preview(t.chain.beliefs, t.chain.atomic)


@query
def a12_contradiction_preview(t: Inputs) -> DataFrame:
    c = t.kept
    return previews.contradiction_preview(c.contradictions, c.canonicals)


# --- B: parsing and checks ------------------------------------------------------------


@query
def b1_accepted(t: Inputs) -> DataFrame:
    return t.chain.utterances.select(
        "utterance_id", "episode_id", "speaker", "timestamp_start", "timestamp_end", "start_s", "end_s", "line_no", "text"
    )


@query
def b2_rejected(t: Inputs) -> DataFrame:
    return t.chain.rejects.select("episode_id", "line_no", "error")


@query
def b3_talk_time(t: Inputs) -> DataFrame:
    return ingest.talk_time(t.chain.utterances)


@query
def b3_durations(t: Inputs) -> DataFrame:
    return ingest.durations(t.chain.utterances)


@query
def b4_repaired_starts(t: Inputs) -> DataFrame:
    """Every rejected line counts as one without a start."""
    rows = t.chain.parsed.select(
        "episode_id", "line_no", F.when(F.col("error").isNull(), F.col("start_s")).alias("start_s")
    )
    return ingest.repair_starts(rows).select("episode_id", "line_no", "start_filled_s", "repaired")


def _references(t: Inputs) -> DataFrame:
    """Ids, links, dates, paths and scores of every turn, some of them broken."""
    h = hash16(F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")))
    name = tables.episode_name(F.col("conv_id"))
    second = (F.col("turn") * 60).cast("string")
    return t.table("conversations").select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"),
        F.when(h % 11 == 0, F.concat(name, F.lit(" x"))).when(h % 11 == 1, "").otherwise(name).alias("episode_id"),
        F.when(h % 13 == 0, F.concat(name, F.lit(".mp3")))
        .when(h % 13 == 1, F.concat(F.lit("#t="), second))
        .when(h % 13 == 2, F.concat(name, F.lit(".mp3#t=1s")))
        .when(h % 13 == 3, F.concat(name, F.lit(".mp3#t=1#t=2")))
        .when(h % 13 < 8, F.concat(name, F.lit(".mp3#t="), second, F.lit(",99999")))
        .otherwise(F.concat(name, F.lit(".mp3#t="), second))
        .alias("audio_uri"),
        F.when(h % 17 == 0, "2024-13-01").when(h % 17 == 1, "soon").otherwise("2024-01-31").alias("date"),
        F.when(h % 19 == 0, "").otherwise(F.concat(name, F.lit(".txt"))).alias("path"),
        ((h % 120) / 100).alias("score"),
    )


@query
def b5_reference_checks(t: Inputs) -> DataFrame:
    return contracts.link_violations(_references(t))


@query
def b6_contract_violations(t: Inputs) -> DataFrame:
    """Raw lines and raw beliefs against the record rules; rejected ones show up by rule."""
    c = t.chain
    key = F.concat_ws("-", "episode_id", F.col("line_no").cast("string"))
    raw = contracts.violations(c.parsed.withColumn("id", key), "utterance", "id", contracts.utterance_rules())
    read = contracts.violations(c.read, "belief", "belief_id", contracts.belief_rules())
    return raw.unionByName(read)


@query
def b6_result_contracts(t: Inputs) -> DataFrame:
    """Cells, drift, contradictions and reports against their rules: number of violations per entity."""
    c = t.kept
    cell_id = c.cells.withColumn("id", F.concat_ws("-", "episode_id", "canonical_id"))
    parts = [
        contracts.violations(cell_id, "weight", "id", contracts.weight_rules()),
        contracts.violations(c.drift, "drift", "drift_id", contracts.drift_rules()),
        contracts.violations(c.contradictions, "contradiction", "contradiction_id", contracts.contradiction_rules()),
        contracts.violations(quality_reports(c), "report", "episode_id", contracts.report_rules()),
        contracts.violations(canonical.member_lists(c.mentions, PARAMS), "canonical", "canonical_id", contracts.canonical_rules()),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.agg(F.count(F.lit(1)).alias("violations"))


@query
def b6_broken_records(t: Inputs) -> DataFrame:
    """Records of every result entity made from all documents, each rule broken in some of them: violations by rule."""
    rows = t.table("documents").select(F.col("doc_id").alias("id"))

    def unless(every: int, rest: int, good: object, bad: object) -> Column:
        def value(x: object) -> Column:
            return x if isinstance(x, Column) else F.lit(x)

        return F.when(F.col("id") % every == rest, value(bad)).otherwise(value(good))

    episodes = rows.select(
        "id", unless(7, 1, F.concat(F.lit("ep_"), F.col("id").cast("string")), "no id!").alias("episode_id"),
        unless(11, 2, "2024-02-29", "2023-02-29").alias("date"), unless(13, 3, "a/b.txt", "").alias("transcript_path"),
        unless(17, 4, unless(17, 5, 80.0, None), 101.0).alias("quality_score"), unless(19, 6, "B", "E").alias("quality_grade"),
    )
    clusters = rows.select("id", unless(13, 3, F.col("id") % 5 + 1, 0).alias("members")).select(
        "id", "members", unless(11, 2, F.col("members"), F.col("members") + 1).alias("size"),
        unless(7, 1, "core", unless(2, 0, "nothing", None)).alias("ontology_level"),
    )
    weights = rows.select(
        "id", unless(7, 1, unless(7, 2, unless(7, 3, 0.5, None), float("nan")), 1.5).alias("conviction_avg"),
        unless(11, 2, 3, -1).alias("frequency"), unless(13, 3, 1.0, -0.1).alias("stability_score"),
    )
    events = rows.select(
        "id", unless(7, 1, fixed.DRIFT_KINDS[0], "odd").alias("drift_type"), unless(11, 2, 0.0, 2.0).alias("magnitude"),
        unless(13, 3, F.array(F.lit("a"), F.lit("b")), F.array(F.lit("a"))).alias("episode_range"),
    )
    opposed = rows.select(
        "id", unless(7, 1, 0.9, None).alias("opposition_score"),
        unless(11, 2, unless(2, 0, "cross_speaker", "within_speaker"), "unlike").alias("type"), unless(13, 3, False, True).alias("is_reversal"),
    )
    reports = rows.select(
        "id", unless(7, 1, 100.0, -1.0).alias("quality_score"), unless(11, 2, "F", None).alias("quality_grade"),
        unless(13, 3, 0, -1).alias("errors_count"), unless(17, 4, 0, -1).alias("retries_count"),
        unless(19, 5, 0, -1).alias("malformed_beliefs_count"), unless(23, 6, 0, -1).alias("registry_mismatches_count"),
        unless(29, 7, 1.5, -0.5).alias("execution_time_seconds"),
    )
    found = [
        contracts.violations(episodes, "episode", "id", contracts.episode_rules()),
        contracts.violations(clusters, "cluster", "id", contracts.cluster_rules()),
        contracts.violations(weights, "weight", "id", contracts.weight_rules()),
        contracts.violations(events, "drift", "id", contracts.drift_rules()),
        contracts.violations(opposed, "contradiction", "id", contracts.contradiction_rules()),
        contracts.violations(reports, "report", "id", contracts.report_rules()),
    ]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.groupBy("entity", "rule").agg(F.count(F.lit(1)).alias("violations"))


@query
def b7_orphans(t: Inputs) -> DataFrame:
    """References that lead nowhere: sentences are no lines, and not every caller is an episode."""
    c = t.chain
    found = c.certain
    parts = [
        contracts.orphans("utterance-episode", c.atomic, "utterance_id", "episode_id", c.episodes, "episode_id"),
        contracts.orphans("belief-utterance", c.beliefs, "belief_id", "utterance_id", c.atomic, "utterance_id"),
        contracts.orphans("belief-line", c.beliefs, "belief_id", "utterance_id", c.utterances, "utterance_id"),
        contracts.orphans("canonical-belief", canonical.members(c.mentions), "canonical_id", "belief_id", c.beliefs, "belief_id"),
        contracts.orphans("contradiction-canonical", found, "b", "a", c.canonicals, "canonical_id"),
        contracts.orphans("drift-canonical", drift.events(c.cells, c.episodes), "drift_id", "canonical_id", c.canonicals, "canonical_id"),
        contracts.orphans("call-episode", t.calls, "call_id", "episode_id", c.episodes, "episode_id"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query
def b7_broken_links(t: Inputs) -> DataFrame:
    """Links of all records against what the earlier half of the episodes knows, so that every edge is broken somewhere."""
    c = t.kept
    old, _ = t.halves(c.mentions)
    old = durable(old)
    known = old.select("canonical_id").distinct()
    membership = c.mentions.select("canonical_id", F.substring("canonical_id", 1, 4).alias("cluster_id")).distinct()
    clusters = old.select(F.substring("canonical_id", 1, 4).alias("cluster_id")).distinct()
    found = c.certain.withColumn("pair", F.concat_ws("-", "a", "b"))
    parts = [
        contracts.orphans("canonical-utterance", c.mentions, "belief_id", "utterance_id", old, "utterance_id"),
        contracts.orphans("canonical-belief", canonical.members(c.mentions), "canonical_id", "belief_id", old, "belief_id"),
        contracts.orphans("canonical-cluster", membership, "canonical_id", "cluster_id", clusters, "cluster_id"),
        contracts.orphans("cluster-canonical", membership, "cluster_id", "canonical_id", known, "canonical_id"),
        contracts.orphans("contradiction-a", found, "pair", "a", known, "canonical_id"),
        contracts.orphans("contradiction-b", found, "pair", "b", known, "canonical_id"),
        contracts.orphans("drift-canonical", drift.events(c.cells, c.episodes), "drift_id", "canonical_id", known, "canonical_id"),
        contracts.orphans("utterance-episode", c.atomic, "utterance_id", "episode_id", old, "episode_id"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query
def b8_repeated_ids(t: Inputs) -> DataFrame:
    c = t.chain
    return contracts.repeated_ids(c.normal, "form", "norm_hash").unionByName(
        contracts.repeated_ids(c.beliefs, "belief", "belief_id")
    )


@query
def b9_audio_links(t: Inputs) -> DataFrame:
    c = t.chain
    audio = c.episodes.withColumn(
        "audio_uri", F.when(F.col("episode_seq") % 3 != 0, F.concat("episode_id", F.lit(".mp3")))
    )
    one = ingest.audio_links(c.utterances, audio, "s://audio/").select("utterance_id", "audio_snippet_uri")
    two = ingest.audio_links(c.utterances, audio, "", ranged=True).select(
        "utterance_id", F.col("audio_snippet_uri").alias("ranged_uri")
    )
    return one.join(two, "utterance_id")


# --- C: splitting -------------------------------------------------------------------


@query
def c1_sentences(t: Inputs) -> DataFrame:
    return t.chain.atomic.select("utterance_id", "parent_id", "episode_id", "line_no", "sentence_no", "speaker", "text")


@query
def c2_split_counts(t: Inputs) -> DataFrame:
    return split.split_counts(t.chain.atomic)


# --- D: extraction ------------------------------------------------------------------


@query
def d1_prompts(t: Inputs) -> DataFrame:
    return extract.prompts(t.chain.atomic).select("utterance_id", F.md5("prompt").alias("prompt_md5"))


@query
def d2_batches(t: Inputs) -> DataFrame:
    return extract.batches(t.chain.atomic, PARAMS).select("utterance_id", "item_no", "batch_no")


def _counting_model(frame: pd.DataFrame) -> pd.DataFrame:
    """A stand-in for a user's model: refuses some texts, answers the others with their length."""
    size = frame["text"].str.len()
    if (size % 50 == 0).any():
        raise ValueError("Request timed out")
    return pd.DataFrame(
        {
            "utterance_id": frame["utterance_id"],
            "response": '{"n": ' + size.astype(str) + "}",
            "error": None,
            "tokens": size,
            "latency": 0.0,
        }
    )


def _short_model(frame: pd.DataFrame) -> pd.DataFrame:
    """A model that answers some texts twice and leaves others out."""
    out = _counting_model(frame[frame["text"].str.len() % 50 != 0])
    size = frame.set_index("utterance_id")["text"].str.len().reindex(out["utterance_id"]).to_numpy()
    return pd.concat([out[size % 7 != 0], out[size % 11 == 1]])


@query
def d3_short_answers(t: Inputs) -> DataFrame:
    """Every utterance asked about has one row, whatever the model leaves out or doubles."""
    return extract.call_model(extract.spread(t.chain.atomic).select("utterance_id", "text"), _short_model, params=PARAMS).select(
        "utterance_id", "response", "error", "tokens"
    )


@query
def d3_resumed(t: Inputs) -> DataFrame:
    """Answers stored by an earlier run are not asked for again: they keep the mark they were stored with."""
    c = t.chain
    folder = t.scratch()
    where = c.atomic.select("utterance_id", "episode_id", "speaker")
    earlier = c.answers.join(where, "utterance_id").filter("speaker = 'USER'").withColumn("response", F.concat("response", F.lit(" ")))
    snapshots.save(earlier, folder, "beliefs_raw", "first", "2024-01-01 00:00:00")
    stored = snapshots.load(t.spark, folder, "beliefs_raw").select("utterance_id", "response")
    again = Conversations(t.lines, tables.responses, PARAMS, RUN_DATE, stored=stored)
    return again.answers.select("utterance_id", F.md5("response").alias("response_md5"))


@query
def d3_model_calls(t: Inputs) -> DataFrame:
    return extract.call_model(extract.spread(t.chain.atomic).select("utterance_id", "text"), _counting_model).select(
        "utterance_id", "response", "error", "tokens"
    )


@query
def d4_beliefs(t: Inputs) -> DataFrame:
    true_flags = F.map_keys(F.map_filter("extraction_flags", lambda _, v: v))
    return t.chain.beliefs.select(
        "belief_id", "utterance_id", "ordinal", "belief_text", "confidence", F.md5("original_quote").alias("quote_md5"),
        join_list(F.array_sort(true_flags)).alias("true_flags"), F.size("extraction_flags").alias("n_flags"),
    )


@query
def d5_malformed(t: Inputs) -> DataFrame:
    return extract.malformed(t.chain.read)


@query
def d6_failures(t: Inputs) -> DataFrame:
    c = t.chain
    return extract.failures(c.answers).join(c.atomic.select("utterance_id", "episode_id"), "utterance_id")


@query
def d7_first_items(t: Inputs) -> DataFrame:
    return extract.first_items(t.chain.atomic, 10).select("episode_id", "utterance_id", "item_no")


@query
def d8_call_costs(t: Inputs) -> DataFrame:
    return extract.call_costs(t.calls, params=PARAMS).select(
        "episode_id", "api_calls", "api_tokens", r6("api_cost_usd").alias("api_cost_usd"),
        r6("api_latency_avg").alias("api_latency_avg"), "api_errors",
    )


# --- E: registry and canonical beliefs -------------------------------------------------


@query
def e1_one_per_belief(t: Inputs) -> DataFrame:
    c = t.chain
    rows = registry.one_per_belief(c.beliefs.join(c.atomic.select("utterance_id", "episode_id"), "utterance_id"))
    return rows.select(
        "canonical_id", "canonical_text", F.col("belief_ids")[0].alias("belief_id"),
        F.col("source_utterance_ids")[0].alias("utterance_id"), F.md5(F.col("example_quotes")[0]).alias("quote_md5"),
        "first_seen_episode", "last_seen_episode",
    )


def _literal_alias(mentions: DataFrame) -> DataFrame:
    """Aliases as the literal mode makes them: one entry per belief, numbered by episode."""
    rows = mentions.withColumn("canonical_id", content_id(F.lit("canonical"), F.col("belief_id")))
    return registry.alias_rows(rows.select("belief_text", "canonical_id", "episode_seq"), "belief_text", F.col("episode_seq"))


@query
def e2_alias_lookup(t: Inputs) -> DataFrame:
    old, new = t.halves(t.kept.mentions)
    aliases = registry.latest(_literal_alias(old), ["alias_text"], "seq")
    return registry.find_by_text(new, aliases).select("belief_id", "alias_canonical_id")


@query
def e3_alias_upsert(t: Inputs) -> DataFrame:
    old, new = t.halves(t.kept.mentions)
    return registry.upsert_aliases(_literal_alias(old), _literal_alias(new))


@query
def e4_canonical_upsert(t: Inputs) -> DataFrame:
    def entries(m: DataFrame) -> DataFrame:
        return m.select("canonical_id", F.col("belief_text").alias("canonical_text"), "belief_id", F.col("episode_seq").alias("seq"))

    old, new = t.halves(t.kept.mentions)
    return registry.upsert(entries(old), entries(new), ["canonical_id"], "seq")


@query
def e5_history(t: Inputs) -> DataFrame:
    def rows(m: DataFrame) -> DataFrame:
        return m.select("canonical_id", "episode_id", F.col("episode_seq").alias("seq"))

    old, new = t.halves(t.kept.mentions)
    return registry.append_history(rows(old), rows(new))


@query
def e5_history_lists(t: Inputs) -> DataFrame:
    rows = t.chain.mentions.select("canonical_id", "episode_id", F.col("episode_seq").alias("seq"))
    lists = registry.history_lists(registry.append_history(rows.limit(0), rows), 50)
    return lists.select("canonical_id", "page_no", join_list("episode_ids").alias("episode_ids"))


def _text_vectors(rows: DataFrame) -> DataFrame:
    return similar.embed_text(rows, norm_tokens(F.col("canonical_text"), PARAMS)).select("canonical_id", "embedding")


@query
def e6_embedding_cache(t: Inputs) -> DataFrame:
    """Canonicals of the later half: embedding cached by the earlier half, or newly made."""
    old, new = t.halves(t.kept.mentions)
    cache = _text_vectors(canonical.summaries(old))
    wanted = canonical.summaries(new).select("canonical_id", "canonical_text")
    made = _text_vectors(registry.missing_embeddings(wanted, cache))
    out = registry.cached_embeddings(wanted.select("canonical_id"), cache, made)
    return out.select("canonical_id", "origin", F.size("embedding").alias("dims"))


@query
def e7_text_embeddings(t: Inputs) -> DataFrame:
    v = _text_vectors(t.chain.forms.select(F.col("norm_hash").alias("canonical_id"), F.col("norm_text").alias("canonical_text")))
    filled = F.filter("embedding", lambda x: x != 0)
    places = F.filter(F.transform("embedding", lambda x, i: F.when(x != 0, i)), lambda i: i.isNotNull())
    return v.select(
        "canonical_id", join_list(F.transform(places, lambda i: i.cast("string"))).alias("places"),
        r6(F.aggregate(filled, F.lit(0.0), lambda s, x: s + x)).alias("total"),
    )


@query
def e8_nearest_canonical(t: Inputs) -> DataFrame:
    """A near copy and a reversed copy of every vector against all given vectors."""
    given = t.table("embeddings")

    def rows(mark: str, v: Column) -> DataFrame:
        return given.select(F.concat(F.lit(mark), F.col("vec_id").cast("string")).alias("belief_id"), v.alias("embedding"))

    asked = rows("n", tables.bump(F.col("embedding"), 1)).unionByName(rows("r", F.reverse("embedding").cast("array<double>")))
    base = given.select(
        F.concat(F.lit("c"), F.col("vec_id").cast("string")).alias("canonical_id"), F.col("embedding").cast("array<double>").alias("embedding")
    )
    near = similar.nearest_above(asked, base, "belief_id", "canonical_id", PARAMS.match_similarity, params=PARAMS)
    return similar.match_or_new(asked, near).select("belief_id", "canonical_id", "is_new", r6("similarity").alias("similarity"))


@query
def e9_normalized(t: Inputs) -> DataFrame:
    return t.chain.normal.select("belief_id", "norm_text", "norm_hash")


@query
def e10_exact_groups(t: Inputs) -> DataFrame:
    return t.chain.forms


@query
def e11_fuzzy_pairs(t: Inputs) -> DataFrame:
    return t.chain.close_forms.select("a", "b", r6("ratio").alias("ratio"))


@query
def e12_fuzzy_groups(t: Inputs) -> DataFrame:
    c = t.chain
    return with_singletons(c.forms.select("norm_hash"), "norm_hash", c.fuzzy_groups)


@query
def e13_canonicals(t: Inputs) -> DataFrame:
    return canonical.summaries(t.chain.fuzzy_mentions).select(
        "canonical_id", "canonical_text", "mentions", "first_seen_episode", "last_seen_episode"
    )


@query
def e13_member_lists(t: Inputs) -> DataFrame:
    return canonical.member_lists(t.chain.mentions, PARAMS).select(
        "canonical_id", "page_no", join_list("belief_ids").alias("belief_ids"),
        F.size("source_utterance_ids").alias("n_utterances"), F.size("example_quotes").alias("n_quotes"),
    )


_MERGED = ["canonical_id", "mentions", "first_seq", "first_seen_episode", "last_seq", "last_seen_episode"]


@query
def e14_incremental_merge(t: Inputs) -> DataFrame:
    """Canonicals of the later half merged into those of the earlier half; stored texts stay."""
    old, new = t.halves(t.kept.mentions)
    merged = registry.merge_canonicals(
        canonical.summaries(old).drop("norm_text"), canonical.summaries(new).drop("norm_text")
    )
    return merged.select("canonical_text", *_MERGED)


@query
def e15_rephrased(t: Inputs) -> DataFrame:
    """Forms that almost reach the fuzzy threshold go to a model; where it fails the form stays."""
    c = t.chain
    loose = similar.fuzzy_pairs(
        c.forms.select(F.col("norm_hash").alias("canonical_id"), "norm_text"), Params(fuzzy_ratio=0.8)
    )
    asked = canonical.ambiguous_forms(loose, F.col("ratio") < PARAMS.fuzzy_ratio).join(c.forms, "norm_hash")

    answers = extract.call_model(
        asked.select("norm_hash", "norm_text"), _rephrasing_model, "norm_hash string, response string, error string"
    )
    return canonical.rephrased(c.forms, answers).select("norm_hash", "canonical_text")


def _rephrasing_model(frame: pd.DataFrame) -> pd.DataFrame:
    if (frame["norm_text"].str.len() % 10 == 0).any():
        raise ValueError("HTTP 503")
    return pd.DataFrame({"norm_hash": frame["norm_hash"], "response": "that " + frame["norm_text"], "error": None})


def _mismatched(t: Inputs) -> DataFrame:
    """Later beliefs whose text names another canonical than their nearest embedding.

    Only a text that the earlier half has as an alias can do so: such texts alone are
    embedded, each once, and looked up.
    """
    old, new = t.halves(t.kept.mentions)
    stored = canonical.summaries(old)
    base = similar.embed_text(stored, norm_tokens(F.col("canonical_text"), PARAMS)).select("canonical_id", "embedding")
    aliases = registry.latest(
        registry.alias_rows(old.select("belief_text", "canonical_id", "episode_seq"), "belief_text", F.col("episode_seq")),
        ["alias_text"], "seq",
    )
    found = durable(
        registry.find_by_text(new.select("belief_id", "episode_id", "belief_text"), aliases).filter("alias_canonical_id IS NOT NULL")
    )
    texts = found.select("belief_text").distinct()
    asked = similar.embed_text(texts, norm_tokens(F.col("belief_text"), PARAMS))
    near = similar.nearest_above(asked, base, "belief_text", "canonical_id", PARAMS.match_similarity, params=PARAMS)
    return registry.mismatches(found, found.select("belief_id", "belief_text").join(near, "belief_text"))


@query
def e16_mismatches(t: Inputs) -> DataFrame:
    return _mismatched(t).groupBy("episode_id").agg(F.count(F.lit(1)).alias("mismatches"))


@query
def e17_rebuilt_registry(t: Inputs) -> DataFrame:
    """All canonicals from all stored beliefs; equal to the incremental merge but for the choice of text."""
    return canonical.summaries(t.chain.mentions).select(*_MERGED)


@query
def e17_rebuilt_from_snapshots(t: Inputs) -> DataFrame:
    """A registry whose newest version lost a table, built anew from the stored phase."""
    folder, mentions = t.scratch(), durable(t.chain.mentions)
    snapshots.save(mentions, f"{folder}/phases", "canonical_beliefs", "one", "2024-01-01 00:00:00")
    broken = {k: v for k, v in stores.empty_registry(t.spark).items() if k != "alias"}
    stores.save_registry(broken, f"{folder}/registry", 0)
    registry_streams.rebuild(t.spark, f"{folder}/registry", f"{folder}/phases")
    return stores.load_registry(t.spark, f"{folder}/registry")["canonical"].select(*_MERGED)


# --- F: clusters ----------------------------------------------------------------------


def _vectors(t: Inputs, mentions: DataFrame | None = None) -> DataFrame:
    """Vectors of the canonicals of ``mentions``; a query that reads them for nothing else need not have them written."""
    return tables.canonical_vectors(canonical.summaries(t.kept.heard if mentions is None else mentions), t.table("embeddings"))


@query
def f1_close_pairs(t: Inputs) -> DataFrame:
    pairs = cluster.close_pairs(written(_vectors(t)), PARAMS.cluster_distance, PARAMS)
    return pairs.select("a", "b", "copies_a", "copies_b", r6("distance").alias("distance"))


@query
def f1_members(t: Inputs) -> DataFrame:
    """Who stands behind each distinct vector of the close pairs: (vector_id, member_id)."""
    return similar.vector_members(_vectors(t), "canonical_id")


@query
def f1_given_vectors(t: Inputs) -> DataFrame:
    """The given vectors with near copies: pairs above the match threshold."""
    rows = tables.vectors_with_copies(t.table("embeddings")).select(
        F.lpad(F.col("vec_id").cast("string"), 8, "0").alias("canonical_id"), "embedding"
    )
    return similar.every_pair(rows, "canonical_id", PARAMS.match_similarity, PARAMS).select(
        "a", "b", r6("similarity").alias("similarity")
    )


def _split_clusters(t: Inputs) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Clusters of the canonicals first seen in the earlier half; vectors of those and of the rest."""
    c = t.kept
    old, new = t.halves(written(canonical.summaries(c.heard).select("canonical_id", F.col("first_seq").alias("episode_seq"))))
    given = t.table("embeddings")
    known, fresh = written(tables.canonical_vectors(old, given)), written(tables.canonical_vectors(new, given))
    return cluster.link_clusters(known, PARAMS.cluster_distance, PARAMS), known, fresh


@query
def f2_assigned(t: Inputs) -> DataFrame:
    membership, known, fresh = _split_clusters(t)
    return cluster.assign(fresh, cluster.centroids(membership, known), PARAMS.cluster_distance, PARAMS).select(
        "canonical_id", "cluster_id", r6("distance").alias("distance")
    )


def _linked(t: Inputs, mentions: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    v = written(_vectors(t, mentions))
    return written(cluster.link_clusters(v, PARAMS.cluster_distance, PARAMS)), v


@query
def f3_linked_clusters(t: Inputs) -> DataFrame:
    return _linked(t)[0]


@query
def f4_outliers(t: Inputs) -> DataFrame:
    return cluster.flag_micro(_linked(t)[0], PARAMS)


@query
def f4_merged(t: Inputs) -> DataFrame:
    """Clusters at a very small distance, then the small ones moved to their nearest large one."""
    v = written(_vectors(t))
    fine = written(cluster.link_clusters(v, 0.0005, PARAMS))
    return cluster.merge_micro(fine, v, PARAMS.cluster_distance, PARAMS)


@query
def f5_clusters(t: Inputs) -> DataFrame:
    mentions = t.kept.mentions
    return cluster.assemble(_linked(t, mentions)[0], t.kept.canonicals)


@query
def f5_centroids(t: Inputs) -> DataFrame:
    membership, v = _linked(t)
    return cluster.centroids(membership, v).select("cluster_id", F.posexplode("centroid").alias("place", "x")).select(
        "cluster_id", "place", r6("x").alias("x")
    )


@query
def f5_member_lists(t: Inputs) -> DataFrame:
    membership, _ = _linked(t, t.kept.mentions)
    return cluster.member_lists(membership, canonical.members(t.kept.mentions), PARAMS).select(
        "cluster_id", "page_no", F.md5(join_list("source_utterance_ids")).alias("utterances_md5"),
        F.size("canonical_ids").alias("n_members"),
    )


@query
def f6_names(t: Inputs) -> DataFrame:
    canonicals = written(canonical.summaries(t.kept.heard).select("canonical_id", "canonical_text"))
    v = written(tables.canonical_vectors(canonicals, t.table("embeddings")))
    membership = written(cluster.link_clusters(v, PARAMS.cluster_distance, PARAMS))
    return cluster.names(membership, v, canonicals, cluster.centroids(membership, v))


@query
def f7_incremental(t: Inputs) -> DataFrame:
    membership, known, fresh = _split_clusters(t)
    return cluster.update(written(membership), known, fresh, PARAMS.cluster_distance, PARAMS)


@query
def f8_bisecting(t: Inputs) -> DataFrame:
    """Top-down clusters (rows only: the seeds of the splits are Spark's own)."""
    return cluster.bisecting(written(_vectors(t)), 8, PARAMS)


@query
def f8_facts(t: Inputs) -> DataFrame:
    """What is fixed about top-down clusters: every id once, at most 8 leaves, none empty, their sizes sum to all."""
    v = written(_vectors(t))
    leaves = cluster.bisecting(v, 8, PARAMS)
    sizes = leaves.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"))
    found = sizes.agg(F.sum("n").alias("members"), (F.count(F.lit(1)) <= 8).alias("few_leaves"), (F.min("n") > 0).alias("none_empty"))
    once = leaves.agg(F.countDistinct("canonical_id").alias("ids")).scalar()
    return found.select("members", once.alias("ids"), "few_leaves", "none_empty")


@query
def f9_metrics(t: Inputs) -> DataFrame:
    return cluster.metrics(_linked(t)[0], PARAMS).select(
        "clusters_total", r6("avg_cluster_size").alias("avg_cluster_size"), "micro_clusters_filtered"
    )


# --- G: tiers and lineage ---------------------------------------------------------------


def _flag_counts(t: Inputs, membership: DataFrame) -> DataFrame:
    flagged = membership.join(t.kept.mentions.select("canonical_id", "extraction_flags"), "canonical_id")
    return ontology.flag_counts(flagged)


@query
def g1_flag_counts(t: Inputs) -> DataFrame:
    return _flag_counts(t, _linked(t, t.kept.mentions)[0])


def _tiers(t: Inputs, membership: DataFrame) -> DataFrame:
    return ontology.tiers(membership.select("cluster_id").distinct(), _flag_counts(t, membership))


@query
def g2_tiers(t: Inputs) -> DataFrame:
    return _tiers(t, _linked(t, t.kept.mentions)[0]).select("cluster_id", "ontology_level", "votes", "is_default")


_OWN_TIERS = {"stated": ["q23_surface_opinion", "q24_factual_claim"], "deep": ["q16_first_principles", "q18_moral_framework"]}


@query
def g2_custom_flags(t: Inputs) -> DataFrame:
    """Tiers by a caller's own rules, here two tiers and some flags left out."""
    membership, _ = _linked(t, t.kept.mentions)
    tiered = ontology.tiers(membership.select("cluster_id").distinct(), _flag_counts(t, membership), _OWN_TIERS)
    return tiered.select("cluster_id", "ontology_level", "votes", "is_default")


@query
def g3_tier_distribution(t: Inputs) -> DataFrame:
    return ontology.distribution(_tiers(t, _linked(t, t.kept.mentions)[0]))


_NEAR = Params(synonyms=PARAMS.synonyms, parent_similarity=0.35)


def _nodes(t: Inputs) -> tuple[DataFrame, DataFrame]:
    membership, v = _linked(t, t.kept.mentions)
    tiered = durable(_tiers(t, membership))
    return durable(ontology.parents(tiered, cluster.centroids(membership, v), _NEAR)), membership


@query
def g4_parents(t: Inputs) -> DataFrame:
    return _nodes(t)[0].select("cluster_id", "ontology_level", "parent_cluster_id", r6("parent_similarity").alias("parent_similarity"))


@query
def g5_tree(t: Inputs) -> DataFrame:
    return ontology.tree(_nodes(t)[0]).withColumn("path", F.array_join("path", "/"))


# six tiers of a caller's own, each of one or two flags
_SIX = {f"t{i}": flags for i, flags in enumerate([list(fixed.FLAGS)[k : k + 2] for k in range(0, 11, 2)])}


@query
def g5_custom_tree(t: Inputs) -> DataFrame:
    """The tree over six tiers, with paths of up to six nodes."""
    membership, v = _linked(t, t.kept.mentions)
    tiered = durable(ontology.tiers(membership.select("cluster_id").distinct(), _flag_counts(t, membership), _SIX))
    nodes = durable(ontology.parents(tiered, cluster.centroids(membership, v), _NEAR))
    return ontology.tree(nodes).withColumn("path", F.array_join("path", "/"))


@query
def g6_trace(t: Inputs) -> DataFrame:
    return ontology.trace(_linked(t, t.kept.mentions)[0], t.kept.mentions).select(
        "cluster_id", "canonical_id", "belief_id", "utterance_id", "episode_id", "speaker"
    )


@query
def g6_node_sources(t: Inputs) -> DataFrame:
    nodes, membership = _nodes(t)
    sources = ontology.rolled_up(ontology.tree(nodes), ontology.trace(membership, t.kept.mentions))
    return sources.groupBy("node_id").agg(F.count(F.lit(1)).alias("sources"), F.min("utterance_id").alias("first_utterance"))


@query
def g7_default_tiers(t: Inputs) -> DataFrame:
    """Clusters that no flag of the caller's rules speaks for; all flags are counted."""
    membership, _ = _linked(t, t.kept.mentions)
    tiered = ontology.tiers(membership.select("cluster_id").distinct(), _flag_counts(t, membership), _OWN_TIERS)
    return ontology.default_count(tiered)


@query
def a11_ontology_report(t: Inputs) -> DataFrame:
    """Nodes with path and sources written as JSON lines and read back."""
    folder = t.scratch()
    nodes, membership = _nodes(t)
    tree = ontology.tree(nodes)
    sources = written(ontology.rolled_up(tree, ontology.trace(membership, t.kept.mentions)))
    stores.write_json(tree.join(ontology.source_lists(sources, PARAMS), tree["cluster_id"] == F.col("node_id")), folder)
    back = t.spark.read.schema(
        "node_id string, ontology_level string, depth int, page_no bigint, source_utterance_ids array<string>"
    ).json(folder)
    return back.select("node_id", "ontology_level", "depth", "page_no", F.size("source_utterance_ids").alias("sources"))


@query
def g5_whole_path(t: Inputs) -> DataFrame:
    """From lines to the tree of tiers, all on text embeddings (SQL would compare all pairs of texts)."""
    return ontology.tree(t.kept.nodes).withColumn("path", F.array_join("path", "/"))


# --- H: matrix --------------------------------------------------------------------------


def _rounded_cells(cells: DataFrame) -> DataFrame:
    return cells.select(
        "episode_id", "canonical_id", r6("conviction_avg").alias("conviction_avg"), "frequency",
        r6("stability_score").alias("stability_score"), "presence_flag",
    )


@query
def h1_weights(t: Inputs) -> DataFrame:
    return _rounded_cells(t.chain.cells)


@query
def h2_dense_matrix(t: Inputs) -> DataFrame:
    """The dense matrix summed up per episode: cells, absent cells, mentions, conviction."""
    c = t.kept
    rows = matrix.dense_blocks(c.episodes, c.cells, PARAMS).select("episode_id", F.explode("weights").alias("w"))
    return rows.groupBy("episode_id").agg(
        F.count(F.lit(1)).alias("cells"),
        F.count_if(~F.col("w.presence_flag")).alias("absent"),
        F.sum("w.frequency").alias("mentions"),
        r6(F.sum("w.conviction_avg")).alias("conviction"),
    )


@query
def h3_cell_lookup(t: Inputs) -> DataFrame:
    """For every cell, the cell of the same canonical one episode later; NULL where absent."""
    cells = t.kept.cells
    asked = cells.select(tables.episode_name(F.col("episode_seq") + 1).alias("episode_id"), "canonical_id")
    return _rounded_cells(matrix.lookup(asked, cells))


@query
def h4_cell_upsert(t: Inputs) -> DataFrame:
    """All cells, then a second writing of those with one mention, which wins."""
    cells = t.kept.cells.withColumn("seq", F.lit(1))
    new = cells.filter("frequency = 1").withColumns({"conviction_avg": F.lit(0.5), "seq": F.lit(2)})
    return matrix.upsert_cells(cells, new).select("episode_id", "canonical_id", r6("conviction_avg").alias("conviction_avg"), "frequency", "seq")


@query
def h5_dimensions(t: Inputs) -> DataFrame:
    return matrix.dimensions(t.kept.cells, t.kept.episodes)


# --- I: drift ---------------------------------------------------------------------------


def _drift_rows(rows: DataFrame) -> DataFrame:
    return rows.select(
        "drift_id", "canonical_id", "drift_type", r6("magnitude").alias("magnitude"),
        F.array_join("episode_range", ">").alias("episode_range"), r6("conviction_before").alias("conviction_before"),
        r6("conviction_after").alias("conviction_after"), "frequency_before", "frequency_after",
    )


def _plain_drift(t: Inputs) -> DataFrame:
    return drift.events(t.kept.cells, t.kept.episodes, None, PARAMS)


@query
def i1_new(t: Inputs) -> DataFrame:
    return _drift_rows(_plain_drift(t).filter("drift_type = 'new'"))


@query
def i2_dropped(t: Inputs) -> DataFrame:
    return _drift_rows(_plain_drift(t).filter("drift_type = 'dropped'"))


@query
def i3_strengthening(t: Inputs) -> DataFrame:
    return _drift_rows(_plain_drift(t).filter("drift_type = 'strengthening'"))


@query
def i4_weakening(t: Inputs) -> DataFrame:
    return _drift_rows(_plain_drift(t).filter("drift_type = 'weakening'"))


@query
def i5_reversals(t: Inputs) -> DataFrame:
    return _drift_rows(t.kept.drift.filter("drift_type = 'reversal'"))


@query
def i6_all_drift(t: Inputs) -> DataFrame:
    return _drift_rows(t.kept.drift)


@query
def i7_drift_counts(t: Inputs) -> DataFrame:
    return drift.counts(t.kept.drift)


@query
def i7_timeline(t: Inputs) -> DataFrame:
    lists = drift.timeline(_plain_drift(t), PARAMS)
    shown = F.transform("events", lambda e: F.concat_ws(":", e["event_seq"].cast("string"), e["drift_type"]))
    return lists.select("canonical_id", "page_no", join_list(shown).alias("events"))


@query
def a11_timeline_report(t: Inputs) -> DataFrame:
    """Drift timelines written as JSON lines and read back."""
    folder = t.scratch()
    stores.write_json(drift.timeline(_plain_drift(t), PARAMS), folder)
    event = "struct<event_seq:bigint,drift_type:string,start_episode:string,end_episode:string,magnitude:double>"
    back = t.spark.read.schema(f"canonical_id string, page_no bigint, events array<{event}>").json(folder)
    shown = F.transform("events", lambda e: F.concat_ws(":", e["event_seq"].cast("string"), e["drift_type"]))
    return back.select("canonical_id", "page_no", join_list(shown).alias("events"))


# --- J: contradictions --------------------------------------------------------------------


@query
def j1_j2_candidates(t: Inputs) -> DataFrame:
    return t.kept.opposed.select("a", "b", r6("score").alias("score"))


@query
def j3_certain_pairs(t: Inputs) -> DataFrame:
    return t.kept.certain.select("a", "b", r6("score").alias("score"))


@query
def j4_j5_contradictions(t: Inputs) -> DataFrame:
    return t.kept.contradictions.withColumn("opposition_score", r6("opposition_score"))


def _pair_counts(c: Conversations) -> DataFrame:
    return contradict.pair_counts(c.certain, c.mentions)


@query
def j4_pair_counts(t: Inputs) -> DataFrame:
    """One row per pair of claims that oppose each other, however many speakers hold them."""
    return _pair_counts(t.kept).withColumn("opposition_score", r6("opposition_score"))


@query
def j4_episode_lists(t: Inputs) -> DataFrame:
    c = t.kept
    lists = contradict.episode_lists(contradict.where_held(c.contradictions, c.mentions), PARAMS)
    return lists.select("contradiction_id", "page_no", join_list(F.array_sort("episode_ids")).alias("episode_ids"))


def _verdict_model(frame: pd.DataFrame) -> pd.DataFrame:
    return frame[["a", "b"]].assign(opposed=frame["a"].str[:1] < "8", error=None)


@query
def j6_verified(t: Inputs) -> DataFrame:
    """Pairs of the ambiguous band go to a model; the ones it confirms join the certain pairs."""
    pairs = t.kept.opposed
    verdicts = extract.call_model(
        contradict.ambiguous(pairs, PARAMS), _verdict_model, "a string, b string, opposed boolean, error string"
    )
    return contradict.confirmed(pairs, verdicts, PARAMS).select("a", "b", r6("score").alias("score"))


@query
def j7_counts_by_type(t: Inputs) -> DataFrame:
    return contradict.counts_by_type(_pair_counts(t.kept))


@query
def j7_counts_by_speakers(t: Inputs) -> DataFrame:
    return contradict.counts_by_speakers(t.kept.contradictions)


@query
def j7_counts_by_episode(t: Inputs) -> DataFrame:
    c = t.kept
    return contradict.counts_by_episode(_pair_counts(c), c.mentions)


@query
def j8_speaker_comparison(t: Inputs) -> DataFrame:
    """All speakers who share a claim, compared over everything they said."""
    return contradict.overlaps(t.kept.mentions)


@query
def j8_speaker_claims(t: Inputs) -> DataFrame:
    """What speakers hold: with the pairs that share something, it says what all other pairs differ in."""
    return contradict.claims_of(t.chain.mentions)


@query
def j8_shared_and_own(t: Inputs) -> DataFrame:
    m = t.kept.mentions
    shared = contradict.shared_claims(m, "USER", "ASSISTANT").withColumn("held_by", F.lit("both"))
    return shared.unionByName(contradict.own_claims(m, "USER", "ASSISTANT").withColumn("held_by", F.lit("USER")))


# --- K: quality -----------------------------------------------------------------------------


@query
def k1_counters(t: Inputs) -> DataFrame:
    c = t.kept
    return quality.counters(quality_events(c, t.calls, _mismatched(t)), c.episodes)


@query
def k1_messages(t: Inputs) -> DataFrame:
    rows = quality.messages(quality_events(t.kept, t.calls), PARAMS)
    return rows.select("episode_id", "kind", "page_no", F.array_join("messages", ";").alias("messages"))


@query
def k2_k3_scores(t: Inputs) -> DataFrame:
    return quality_reports(t.kept, t.calls, _mismatched(t)).select("episode_id", "quality_score", "quality_grade")


@query
def k4_reports(t: Inputs) -> DataFrame:
    c = t.kept
    events = durable(quality_events(c, t.calls, _mismatched(t)))
    report = quality.reports(quality.counters(events, c.episodes), _run_times(t), "2024-01-01 00:00:00")
    full = quality.full_reports(report, quality.messages(events, PARAMS))
    return full.select(
        "episode_id", "quality_score", "quality_grade", "errors_count", "retries_count", "malformed_beliefs_count",
        "registry_mismatches_count", "execution_time_seconds", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        "page_no", F.array_join("parsing_errors", ";").alias("parsing_errors"), F.array_join("api_errors", ";").alias("api_errors"),
        F.array_join("warnings", ";").alias("warnings"),
    )


def _run_times(t: Inputs) -> DataFrame:
    return quality.phase_rates(t.manifest).groupBy("episode_id").agg(F.sum("duration_s").alias("execution_time_seconds"))


@query
def k5_summary(t: Inputs) -> DataFrame:
    """Flagship: from transcript lines to the quality of all episodes that reached the last phases."""
    asked = t.manifest.filter("phase = 'canonical_beliefs'").select("episode_id")
    rows = quality.summary(quality_reports(t.kept, t.calls, _mismatched(t)), asked)
    return rows.withColumn("average_score", r6("average_score"))


@query
def k6_phase_rates(t: Inputs) -> DataFrame:
    return quality.phase_rates(t.manifest).withColumns({"duration_s": r6("duration_s"), "rows_per_minute": r6("rows_per_minute")})


@query
def k7_progress_rows(t: Inputs) -> DataFrame:
    c = t.chain
    rows = c.beliefs.join(c.atomic.select("utterance_id", "episode_id", "line_no", "sentence_no"), "utterance_id")
    picked = quality.every_nth(rows, ["episode_id"], ["line_no", "sentence_no", "ordinal"], blocks("line_no"), PARAMS)
    return picked.select("episode_id", "belief_id", "event_no")


@query
def k8_graded_episodes(t: Inputs) -> DataFrame:
    c = t.kept
    return quality.graded_episodes(c.episodes, quality_reports(c, t.calls, _mismatched(t))).select("episode_id", "title", "quality_score", "quality_grade")


@query
def k9_line_counts(t: Inputs) -> DataFrame:
    return ingest.line_counts(t.lines)


# --- L: call log ------------------------------------------------------------------------------


@query
def l1_causes(t: Inputs) -> DataFrame:
    return calls.causes(calls.attempts(t.calls, PARAMS))


@query
def l1_retries(t: Inputs) -> DataFrame:
    return calls.retries(t.calls)


@query
def l2_attempts(t: Inputs) -> DataFrame:
    return calls.attempts(t.calls, PARAMS).select("call_id", "item_id", "attempt", "cause", "wait_s", "exhausted", "given_up")


@query
def l2_waits(t: Inputs) -> DataFrame:
    return calls.waits(calls.attempts(t.calls, PARAMS))


@query
def l3_budget_audit(t: Inputs) -> DataFrame:
    return calls.budget_audit(t.calls, PARAMS).select(
        "call_id", "prior_requests", "prior_tokens", "over_requests", "over_tokens", r6("wait_s").alias("wait_s")
    )


@query
def l3_estimated_tokens(t: Inputs) -> DataFrame:
    """The audit with an estimate in place of the logged tokens."""
    return calls.budget_audit(t.calls, PARAMS, tokens=F.ceil(F.col("latency") * 1000).cast("bigint")).select(
        "call_id", "tokens", "prior_tokens", "over_tokens"
    )


@query
def l4_per_minute(t: Inputs) -> DataFrame:
    return _minutes(calls.per_minute(t.calls))


def _minutes(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.date_format("minute", "yyyy-MM-dd HH:mm:ss").alias("minute"), "api_calls", "api_tokens",
        r6("api_latency_avg").alias("api_latency_avg"), "api_errors", "api_retries",
    )


# --- M: streams ---------------------------------------------------------------------------------


# a trigger of the stream of transcript files takes 50 of them, or more where these would be more triggers than so many
_TRIGGERS = 20


@query
def m1_streamed_utterances(t: Inputs) -> DataFrame:
    """Transcript files written from the lines, read as a stream in several triggers."""
    folder = t.scratch()
    t.lines.repartition("episode_id").sortWithinPartitions("episode_id", "line_no").select(
        "episode_id", F.col("line").alias("value")
    ).write.partitionBy("episode_id").text(f"{folder}/in")
    files = t.table("conversations").agg(F.count_distinct("conv_id")).first()[0]
    lines = transcripts.stream_lines(t.spark, f"{folder}/in", max(50, -(-files // _TRIGGERS))).withColumn(
        "episode_id", F.regexp_extract("transcript_path", "episode_id=([^/]+)", 1)
    )
    transcript_streams.ingest_stream(lines, f"{folder}/out", f"{folder}/state").awaitTermination()
    done = t.spark.read.parquet(f"{folder}/out/utterances")
    return done.select("episode_id", "line_no", "speaker", "start_s", "end_s", F.md5("text").alias("text_md5"))


@query
def m2_streamed_registry(t: Inputs) -> DataFrame:
    """Mentions as a stream of files, merged into the registry batch by batch."""
    folder, mentions = t.scratch(), t.chain.mentions
    mentions.drop("extraction_flags").withColumn("_part", F.col("episode_seq") % 3).repartition("_part").write.partitionBy(
        "_part"
    ).parquet(f"{folder}/in")
    batch = t.spark.read.parquet(f"{folder}/in")
    stream = t.spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    registry_streams.registry_stream(stream, f"{folder}/registry", f"{folder}/state").awaitTermination()
    return stores.load_registry(t.spark, f"{folder}/registry")["canonical"].select(*_MERGED)


@query
def m2_second_stream(t: Inputs) -> DataFrame:
    """A registry saved by a batch job, then two streams with checkpoints of their own, one batch played twice."""
    folder = t.scratch()
    old, new = t.halves(durable(t.chain.mentions))
    stores.save_registry(registry_streams.merge_batch(stores.empty_registry(t.spark), old), f"{folder}/registry", 0)
    for part, rows in (("one", new.filter("episode_seq % 2 = 0")), ("two", new.filter("episode_seq % 2 = 1"))):
        rows.drop("extraction_flags").write.parquet(f"{folder}/in/{part}")
        batch = t.spark.read.parquet(f"{folder}/in/{part}")
        stream = t.spark.readStream.schema(batch.schema).parquet(f"{folder}/in/{part}")
        registry_streams.registry_stream(stream, f"{folder}/registry", f"{folder}/state-{part}").awaitTermination()
        registry_streams.write_batch(batch, 0, f"{folder}/registry", f"{folder}/state-{part}")
    return stores.load_registry(t.spark, f"{folder}/registry")["canonical"].select(*_MERGED)


def _event_stream(t: Inputs) -> DataFrame:
    schema = t.table("events").schema
    return t.spark.readStream.schema(schema).parquet(f"{t.folder}/events*.parquet")


def _simple_calls(events: DataFrame) -> DataFrame:
    """Row-local call log, as a stream cannot look back over all events of a caller."""
    return events.select(
        F.col("event_id").alias("call_id"), F.col("user_id").alias("caller"), F.col("ts").cast("timestamp").alias("ts"),
        F.floor(F.col("value") * 10).cast("bigint").alias("tokens"), (F.col("value") / 100).alias("latency"),
        (F.col("event_type") != "error").alias("success"),
        F.when(F.col("event_type") == "error", (F.col("event_id") % 4 + 1).cast("int")).otherwise(1).alias("attempt"),
    )


@query
def m3_streamed_minutes(t: Inputs) -> DataFrame:
    """Closed minutes of the event stream."""
    folder = t.scratch()
    rows = call_streams.per_minute(_simple_calls(_event_stream(t)))
    run = rows.writeStream.format("parquet").option("path", f"{folder}/out").option(
        "checkpointLocation", f"{folder}/state"
    ).trigger(availableNow=True).start()
    run.awaitTermination()
    return _minutes(t.spark.read.parquet(f"{folder}/out"))


@query
def m4_streamed_alarm(t: Inputs) -> DataFrame:
    """Calls over budget, found with state per caller and slice of time in five micro-batches, one for each stretch of time."""
    folder, events = t.scratch(), t.table("events")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    cuts = events.agg(F.percentile_approx(at, [0.2, 0.4, 0.6, 0.8])).first()[0] or []
    bounds = [None, *sorted(set(cuts)), None]
    for low, high in zip(bounds, bounds[1:]):  # what has come since the last run is a micro-batch, however many files it is
        above = F.lit(True) if low is None else at > low
        events.filter(above & (F.lit(True) if high is None else at <= high)).write.mode("append").parquet(f"{folder}/in")
        stream = t.spark.readStream.schema(events.schema).parquet(f"{folder}/in")
        rows = call_streams.budget_alarm(_simple_calls(stream), PARAMS)
        run = rows.writeStream.format("parquet").option("path", f"{folder}/out").option(
            "checkpointLocation", f"{folder}/state"
        ).trigger(availableNow=True).start()
        run.awaitTermination()
    return t.spark.read.parquet(f"{folder}/out").select(
        "call_id", "prior_requests", "prior_tokens", "over_requests", "over_tokens"
    )
