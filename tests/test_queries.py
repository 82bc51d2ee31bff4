"""Queries against their SQL at the smallest scale, one per kind of work (all: ``python check.py``)."""

import check
import pytest

FOLDER = "/root/testdata/sf0.001"
NAMES = (
    "a1_file_lines a3_a4_snapshot_round_trip a5_resume_points a6_expired a9_matrix_csv a12_belief_preview b1_accepted b2_rejected "
    "b4_repaired_starts b5_reference_checks b6_contract_violations c1_sentences d2_batches d3_model_calls d4_beliefs d5_malformed "
    "d6_failures d7_first_items e2_alias_lookup e5_history_lists e8_nearest_canonical e11_fuzzy_pairs e13_canonicals "
    "e14_incremental_merge f1_close_pairs f4_merged f7_incremental g4_parents g5_tree h2_dense_matrix h4_cell_upsert i6_all_drift "
    "j4_j5_contradictions j8_speaker_comparison k4_reports k5_summary k7_progress_rows l2_attempts l3_budget_audit "
    "m1_streamed_utterances m2_streamed_registry m3_streamed_minutes m4_streamed_alarm a3_smaller_rerun a6_purged a8_second_run "
    "b7_broken_links d3_short_answers d3_resumed e17_rebuilt_from_snapshots g5_custom_tree g7_default_tiers m2_second_stream"
).split()


@pytest.fixture(scope="module")
def con():
    return check.connect(FOLDER)


@pytest.mark.parametrize("name", NAMES)
def test_agrees_with_sql(spark, con, name):
    ok, note = check.compare(spark, con, name, FOLDER)
    assert ok, note


def test_every_query_is_registered():
    import __spark_entry__ as entry
    from claimweave.plans.queries import QUERIES
    from oracles import ORACLES

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) - set(ORACLES) == {"f8_bisecting"}


def test_rebuilt_registry_equals_incremental_merge(spark):
    """Merging the halves gives what building from all mentions gives."""
    import __spark_entry__ as entry

    one = entry.queries()["e14_incremental_merge"](spark, FOLDER).drop("canonical_text")
    two = entry.queries()["e17_rebuilt_registry"](spark, FOLDER)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.select(one.columns).collect()))


def test_whole_path_on_text_embeddings(spark, con):
    """Texts whose words cancel have no direction; they are clusters of their own on both sides."""
    ok, note = check.compare(spark, con, "g5_whole_path", FOLDER)
    assert ok, note
