"""The whole way from transcript lines to drift and contradictions, lazily.

Each step is one DataFrame; a caller asks for the steps needed and Spark plans
only those.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.operators import calls as call_ops
from claimweave import fixed
from claimweave.functions.text import norm_tokens
from claimweave.operators import canonical, cluster, contradict, drift, extract, ingest, matrix, ontology, quality, split
from claimweave.operators.similar import embed_text, fuzzy_pairs
from claimweave.operators.groups import components
from claimweave.params import DEFAULT, Params
from claimweave.session import durable, written
from claimweave.sources import snapshots


@dataclass(frozen=True)
class Conversations:
    """Lines in; ``answer`` maps atomic utterances to (utterance_id, response[, error])."""

    lines: DataFrame
    answer: object
    params: Params = DEFAULT
    run_date: str = "2024-01-01"
    keep: bool = False  # write sentences, claims, mentions, canonicals and cells once, when several steps read them
    stored: DataFrame | None = None  # answers of an earlier run: what they hold is not asked again

    @cached_property
    def parsed(self) -> DataFrame:
        return ingest.parse_lines(self.lines)

    @cached_property
    def rejects(self) -> DataFrame:
        return ingest.rejected(self.parsed)

    @cached_property
    def utterances(self) -> DataFrame:
        return ingest.accepted(self.parsed)

    @cached_property
    def episodes(self) -> DataFrame:
        return ingest.episodes(self.lines, self.run_date)

    @cached_property
    def atomic(self) -> DataFrame:
        rows = split.split_sentences(self.utterances)
        return written(rows) if self.keep else rows

    @cached_property
    def answers(self) -> DataFrame:
        """Asked for once and kept, before anything reads them; a stored answer is not asked for again."""
        if self.stored is None:
            return written(self.answer(extract.spread(self.atomic)))
        here = self.stored.join(self.atomic.select("utterance_id"), "utterance_id", "left_semi")
        left = self.atomic.join(self.stored.select("utterance_id"), "utterance_id", "left_anti")
        return written(here.unionByName(self.answer(extract.spread(left)), allowMissingColumns=True))

    @cached_property
    def read(self) -> DataFrame:
        rows = extract.parse_beliefs(self.answers, self.atomic)
        return written(rows) if self.keep else rows

    @cached_property
    def beliefs(self) -> DataFrame:
        return extract.beliefs(self.read)

    @cached_property
    def normal(self) -> DataFrame:
        return canonical.normalized(self.beliefs, self.params)

    @cached_property
    def forms(self) -> DataFrame:
        return canonical.exact_groups(self.normal)

    @property
    def heard(self) -> DataFrame:
        """``mentions`` that are not written, for one reader who takes some columns.

        Unless the beliefs read are kept already, they are read on the way: answers and
        sentences lie side by side then, and only the columns asked for are carried along.
        """
        read = self.read if "read" in self.__dict__ else extract.parse_beliefs(self.answers, self.atomic)
        return canonical.mentions(canonical.normalized(extract.beliefs(read), self.params), self.atomic)

    @cached_property
    def mentions(self) -> DataFrame:
        """Beliefs with canonical id (hash of the normal form), episode and speaker."""
        rows = self.heard
        return written(rows) if self.keep else rows

    @cached_property
    def canonicals(self) -> DataFrame:
        rows = canonical.summaries(self.mentions)
        return written(rows) if self.keep else rows

    @cached_property
    def close_forms(self) -> DataFrame:
        return fuzzy_pairs(self.forms.select(F.col("norm_hash").alias("canonical_id"), "norm_text"), self.params)

    @cached_property
    def fuzzy_groups(self) -> DataFrame:
        return components(self.close_forms.select("a", "b"))

    @cached_property
    def fuzzy_mentions(self) -> DataFrame:
        """As ``mentions``, with forms of like spelling sharing one canonical."""
        return canonical.mentions(self.normal, self.atomic, self.fuzzy_groups)

    @cached_property
    def vectors(self) -> DataFrame:
        """Text embedding of each canonical."""
        rows = embed_text(self.canonicals, norm_tokens(F.col("canonical_text"), self.params))
        return written(rows.select("canonical_id", "embedding"))

    @cached_property
    def membership(self) -> DataFrame:
        """(canonical_id, cluster_id) by single linkage over the text embeddings."""
        return written(cluster.link_clusters(self.vectors, self.params.cluster_distance, self.params))

    @cached_property
    def clusters(self) -> DataFrame:
        return cluster.assemble(self.membership, self.canonicals)

    @cached_property
    def tiers(self) -> DataFrame:
        """Each cluster with the tier that its beliefs' flags speak for."""
        flagged = self.membership.join(self.mentions.select("canonical_id", "extraction_flags"), "canonical_id")
        return ontology.tiers(self.clusters, ontology.flag_counts(flagged))

    @cached_property
    def nodes(self) -> DataFrame:
        """Tiers with parents, ready for ``ontology.tree``."""
        return durable(ontology.parents(durable(self.tiers), cluster.centroids(self.membership, self.vectors), self.params))

    def save(self, folder: str, run_id: str, ts: str) -> None:
        """Write the result of each phase as a snapshot, before the next phase starts; what breaks off keeps those before it."""
        steps = {
            "utterances": lambda: self.utterances,
            "beliefs_raw": lambda: self.beliefs.join(self.atomic.select("utterance_id", "episode_id"), "utterance_id"),
            "canonical_beliefs": lambda: self.mentions.join(self.canonicals.select("canonical_id", "canonical_text"), "canonical_id"),
            "clusters_updated": lambda: self.membership.join(
                self.canonicals.select("canonical_id", F.col("first_seen_episode").alias("episode_id")), "canonical_id"
            ),
        }
        for phase in fixed.PHASES:
            snapshots.save(steps[phase](), folder, phase, run_id, ts)

    @cached_property
    def cells(self) -> DataFrame:
        rows = matrix.weights(self.mentions)
        return written(rows) if self.keep else rows

    @cached_property
    def opposed(self) -> DataFrame:
        rows = contradict.candidates(self.canonicals, self.params)
        return durable(rows) if self.keep else rows

    @cached_property
    def certain(self) -> DataFrame:
        """The certain pairs of ``opposed``, from a search that leaves out the ambiguous ones."""
        found = contradict.candidates(self.canonicals, self.params, self.params.opposition)
        rows = contradict.certain(found, self.params)
        return durable(rows) if self.keep else rows

    @cached_property
    def contradictions(self) -> DataFrame:
        return contradict.contradictions(self.certain, self.mentions)

    @cached_property
    def drift(self) -> DataFrame:
        return drift.events(self.cells, self.episodes, self.contradictions, self.params)


def quality_events(c: Conversations, call_log: DataFrame | None = None, mismatched: DataFrame | None = None) -> DataFrame:
    """Everything that costs an episode points, from every step."""
    where = c.atomic.select("utterance_id", "episode_id", "line_no")
    events = quality.event(c.rejects, "parsing_error", F.col("line_no"), F.col("error"))
    failed = extract.failures(c.answers).select("utterance_id", F.lit("api_error").alias("kind"), "message")
    bad = extract.malformed(c.read).select("utterance_id", F.lit("malformed").alias("kind"), F.lit(None).cast("string").alias("message"))
    told = failed.unionByName(bad).join(where, "utterance_id")
    at = F.when(F.col("kind") == "api_error", F.col("line_no")).otherwise(0).cast("bigint")
    events = events.unionByName(told.select("episode_id", "kind", at.alias("at"), "message"))
    if call_log is not None:
        tried = call_ops.attempts(call_log, c.params)
        events = events.unionByName(quality.event(tried.filter("attempt > 1"), "retry"))
        given_up = tried.filter("given_up")
        events = events.unionByName(quality.event(given_up, "api_error", F.col("call_id"), F.col("error")))
    if mismatched is not None:
        events = events.unionByName(quality.event(mismatched, "mismatch"))
    return events


def quality_reports(
    c: Conversations,
    call_log: DataFrame | None = None,
    mismatched: DataFrame | None = None,
    created: str | None = None,
) -> DataFrame:
    return quality.reports(quality.counters(quality_events(c, call_log, mismatched), c.episodes), created=created)
