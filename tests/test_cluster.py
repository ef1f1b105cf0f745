"""Queries on a session whose master and checkpoint folder are those of a cluster.

The folder is a plain path, as of a mount that all machines share.
"""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[1]))

import __spark_entry__  # noqa: E402
from watchledger import scratch as scratch_module  # noqa: E402
from workload import context as context_module  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
NAMES = [
    "pipeline",
    "op1_mix_sources",
    "op4_toxicity",
    "op5_benchmark_leaks",
    "op6_quality",
    "op8_simhash_components",
    "op9_exact_top_k",
    "op10_warc_round_trip",
    "op11_exact_dedup",
    "op13_conversation_repair",
    "abs_diff",
    "agg_avg",
    "agg_count",
    "agg_count_distinct",
    "agg_count_distinct_if",
    "agg_max",
    "agg_of_agg",
    "agg_ratio_safe",
    "agg_multi_key",
    "agg_sum",
    "amortize_monthly",
    "anti_join_orphans",
    "agg_sum_if",
    "build_checks",
    "case_amount",
    "build_pipeline",
    "case_classify_like",
    "case_recency_status",
    "case_flag",
    "cast_numeric",
    "cast_blank_to_null",
    "coalesce_default",
    "clustered_course_months",
    "cohort_retention",
]


@pytest.fixture(scope="module")
def mounted(spark, tmp_path_factory):
    """The session; its stored tables are shared by the queries of this file."""
    folder = str(tmp_path_factory.mktemp("mount"))
    get = type(spark.conf).get
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(spark.sparkContext, "master", "spark://head:7077")
        patch.setattr(
            type(spark.conf),
            "get",
            lambda self, k, *a: folder if k == "spark.checkpoint.dir" else get(self, k, *a),
        )
        patch.setattr(scratch_module, "_tried", {}, raising=False)
        patch.setattr(context_module, "_contexts", {})
        yield spark


@pytest.mark.parametrize("name", NAMES)
def test_a_query_takes_the_mount(mounted, name):
    assert __spark_entry__.queries()[name](mounted, FOLDER).count() > 0
