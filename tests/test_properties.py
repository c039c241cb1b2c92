"""Property tests: operators against brute force on generated data."""

from collections import Counter

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quayside.operators.quantiles import exact_quantiles
from quayside.operators.reconcile import reconcile_rows

rows = st.lists(
    st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.sampled_from(["a", "b", None])), max_size=25
)


def brute_recon(src, tgt):
    out = {}
    keys = {k for k, _ in src} | {k for k, _ in tgt}
    for k in keys:
        s = Counter(v for kk, v in src if kk == k)
        t = Counter(v for kk, v in tgt if kk == k)
        if not t:
            out[k] = "missing"
        elif not s:
            out[k] = "extra"
        elif s != t:
            out[k] = "changed"
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows, rows)
def test_reconcile_rows_matches_brute_force(spark, src, tgt):
    schema = "k int, v string"
    got = {r.k: r.status for r in reconcile_rows(spark.createDataFrame(src, schema), spark.createDataFrame(tgt, schema), ["k"]).collect()}
    assert got == brute_recon(src, tgt)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.tuples(st.sampled_from(["x", "y", "z"]), st.integers(-50, 50)), min_size=1, max_size=60),
    st.lists(st.floats(0, 1), min_size=1, max_size=3),
    st.integers(1, 6),
)
def test_exact_quantiles_match_numpy(spark, data, probs, parts):
    df = spark.createDataFrame([(g, float(v)) for g, v in data], "g string, v double")
    got = {r.g: [r[f"q{i}"] for i in range(len(probs))] for r in exact_quantiles(df, ["g"], "v", probs, partitions=parts).collect()}
    for g in {g for g, _ in data}:
        vals = np.array([v for gg, v in data if gg == g], dtype=float)
        want = np.quantile(vals, probs)  # linear interpolation
        np.testing.assert_allclose(got[g], want, atol=1e-9)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.text(alphabet="ab\\nr\n\r\"|, \t'é", max_size=12) | st.none(), st.integers(0, 9)), max_size=8))
def test_text_round_trips_through_delimited_files(spark, rows):
    from quayside.session import scratch_path
    from quayside.sinks.delimited import write_delimited
    from quayside.sources.delimited import read_delimited

    df = spark.createDataFrame([(i, t, n) for i, (t, n) in enumerate(rows)], "i long, t string, n int")
    path = write_delimited(df, scratch_path(spark, "text"), sep="|", escape_lines=True)
    if not rows:
        return
    back = read_delimited(spark, path, df.schema, sep="|", escape_lines=True)
    assert sorted(map(tuple, back.collect())) == [(i, t, n) for i, (t, n) in enumerate(rows)]
