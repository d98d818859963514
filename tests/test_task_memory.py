"""The rows of one task: shuffles start with enough partitions whatever number the cluster has set."""

from starbeam.config import FIXTURE
from starbeam.plans import registry
from starbeam.session import INITIAL_PARTITIONS, apply_required_conf

INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def test_report_shuffles_start_with_many_partitions(spark, sf_small):
    assert int(spark.conf.get("spark.sql.shuffle.partitions")) < INITIAL_PARTITIONS
    found = registry.all_queries(FIXTURE)["rp2_report_products"](spark, sf_small)
    exchanges = [line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and all(f", {INITIAL_PARTITIONS}), ENSURE" in line for line in exchanges)
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "8m"


def test_a_larger_number_of_the_session_stays(spark):
    try:
        spark.conf.set(INITIAL, "1234")
        apply_required_conf(spark)
        assert spark.conf.get(INITIAL) == "1234"
    finally:
        spark.conf.unset(INITIAL)
