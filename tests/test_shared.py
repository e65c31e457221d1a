import os

from spendlane import shared


def test_tables_are_removed_from_a_mark_on(spark):
    df = spark.range(5)
    kept = shared.written(df, "kept")
    before = shared.mark(spark)
    gone = shared.written(df, "gone")
    assert gone.count() == kept.count() == 5
    folder = shared.shared_dir(spark).removeprefix("file:")
    assert sum(n.startswith("gone-") for n in os.listdir(folder)) == 1
    assert shared.clean_up(spark, since=before) == 1
    assert not any(n.startswith("gone-") for n in os.listdir(folder))
    assert kept.count() == 5
