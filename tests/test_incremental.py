import pytest
from model import Sums, number_stream, run

from tidemark.operators import incremental
from tidemark.plans import measure

SCHEMA = "key bigint, seq bigint, n bigint"


@pytest.mark.parametrize("group_rows", [10**6, 3])
@pytest.mark.parametrize("null_key", [False, True])
def test_batches_equal_the_whole(table, group_rows, null_key):
    rows = number_stream(11, keys=15, hot=400, null_key=null_key)
    rows += [(99, 10**6, 4), (99, 10**6 + 1, -5)]  # the sum is -1, which is no clear
    rows += [(99, 10**6 + 5, 3)]
    cuts = [rows[:300], rows[300:-1], rows[-1:]]
    state, got = None, []
    for part in cuts:
        df = table(part, SCHEMA)
        layout = measure(df, "key", "seq", group_rows=group_rows)
        scanned = incremental.resume_sums(df, state, layout).persist()
        got += [tuple(r)[:4] for r in incremental.emitted(scanned, layout).collect()]
        state = table(
            incremental.state_after(scanned, layout).collect(),
            "key bigint, total bigint, size bigint, latest bigint",
        )
    models = run(Sums, rows)
    want = [(k, *row) for k, m in models.items() for row in m.out]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    final = {r.key: (r.total, r["size"], r.latest) for r in state.collect()}
    assert final == {k: (sum(m.items), len(m.items), m.latest) for k, m in models.items()}
