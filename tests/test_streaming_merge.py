"""The scorer's tables when finished micro-batches are merged: the same rows in fewer files, played again or not."""

from riskline import constants as C
from riskline.streaming.pipeline import BatchScorer, stored_table
from test_streaming import event, events


def test_merged_tables_hold_the_same_rows(spark, tmp_path):
    start = 1_704_067_200_000_000 + 200 * C.DAY_US
    merged, plain = (BatchScorer(str(tmp_path / n), compact_every=k, explain_alerts=False) for n, k in (("merged", 2), ("plain", 0)))
    for n in range(5):
        rows = events(spark, [event(f"t{n}", start + n * C.DAY_US, amount=10.0 + n), event(f"t{n - 1}", start + n * C.DAY_US)])
        merged(rows, n)
        plain(rows, n)
    merged(rows, 4)  # played again after its merge
    assert merged._table(spark, "predictions").manifest().covered == 3
    for name in ("transactions", "predictions", "transaction_ids"):
        got, want = (stored_table(spark, s.root, name) for s in (merged, plain))
        columns = sorted(c for c in want.columns if c != "batch_id")
        got, want = (sorted(map(str, x.select(columns).collect())) for x in (got, want))
        assert got == want and len(got) == 6  # t-1 ... t4
