"""Properties checked against plain-Python brute force on random small inputs."""

from collections import defaultdict

from hypothesis import given, settings, strategies as st, HealthCheck
from pyspark.sql import functions as F

from clickpulse import operators as op
from clickpulse.functions.share import share_text
from tests import helpers as h

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

visit_rows = st.lists(st.tuples(st.sampled_from(["s1", "s2", "s3"]),   # session
                                st.integers(0, 2 * 3600 - 1),           # second of the day
                                st.integers(1, 5)),                     # page
                      min_size=0, max_size=40)


@SETTINGS
@given(visit_rows, st.sampled_from([19, 16, 13, 10]))
def test_sliced_jumps_equal_brute_force(spark, rows, slice_chars):
    data = [dict(session_id=s, page_id=p, action_time=f"2019-11-26 {sec // 3600:02d}:{sec // 60 % 60:02d}:"
                 f"{sec % 60:02d}") for s, sec, p in rows]
    v = h.visits(spark, data)
    got = sorted(tuple(r) for r in op.page_transitions(v, slice_chars).select("from_page", "to_page", "jumps")
                 .collect())
    by_session = defaultdict(list)
    for i, d in enumerate(data):
        by_session[d["session_id"]].append((d["action_time"], i, d["page_id"]))
    want = defaultdict(int)
    for seq in by_session.values():
        seq.sort()
        for a, b in zip(seq, seq[1:]):
            want[(a[2], b[2])] += 1
    assert got == sorted((a, b, n) for (a, b), n in want.items())


click_rows = st.lists(st.tuples(st.integers(0, 3 * 86400 - 1), st.sampled_from(["u1", "u2", "u3"]),
                                st.sampled_from(["1", "2"])), min_size=0, max_size=40)


@SETTINGS
@given(click_rows, st.integers(1, 4))
def test_event_order_blacklist_equals_brute_force(spark, rows, threshold):
    rows = sorted(set(rows))
    data = [(1574726400000 + s * 1000, "a", "c", u, ad) for s, u, ad in rows]
    c = h.clicks(spark, data)
    got = sorted(r.event_id for r in op.blacklist_filtered_clicks(c, threshold).collect())
    counts, black, want = defaultdict(int), set(), []
    for i, (ts, _a, _c, u, ad) in enumerate(data):          # already in (ts, event_id) order
        if u in black:
            continue
        want.append(i)
        counts[(ts // 86400000, u, ad)] += 1
        if counts[(ts // 86400000, u, ad)] >= threshold:
            black.add(u)
    assert got == want
    assert sorted(r.userid for r in op.blacklist_users(c, threshold).collect()) == sorted(black)


@SETTINGS
@given(st.lists(st.integers(1, 50), min_size=1, max_size=8), st.integers(1, 3))
def test_city_shares_sum_to_100(spark, counts, top):
    cc = [(n, f"c{i}") for i, n in enumerate(counts)]
    df = spark.createDataFrame([(cc, sum(counts))], "cc array<struct<c:bigint,city:string>>, n bigint")
    text = df.select(share_text("cc", "n", top).alias("t")).first().t
    parts = text.split(",")
    assert len(parts) == min(top, len(counts)) + 1 and parts[-1].startswith("other:")
    total = sum(float(p.split(":")[1].rstrip("%")) for p in parts)
    assert abs(total - 100.0) <= 0.05 * len(parts) + 1e-9  # each part is rounded on its own
    others = sum(counts) - sum(n for n, _ in sorted(cc, key=lambda x: (-x[0], x[1]))[:top])
    assert parts[-1] == f"other:{int(others * 1000.0 / sum(counts) + 0.5) / 10.0}%"
    shown = sorted(cc, key=lambda x: (-x[0], x[1]))[:top]
    for (n, city), p in zip(shown, parts):
        assert p == f"{city}:{int(n * 1000.0 / sum(counts) + 0.5) / 10.0}%"


kv = st.lists(st.tuples(st.sampled_from("abcd"), st.integers(0, 9)), max_size=8)


@SETTINGS
@given(kv, kv, kv)
def test_merge_counts_associative_commutative(spark, a, b, c):
    mk = lambda rows: spark.createDataFrame(rows, "k string, clicks bigint")
    A, B, C = mk(a), mk(b), mk(c)
    s = lambda df: sorted(map(tuple, df.collect()))
    left = op.merge_counts(op.merge_counts(A, B, keys=["k"]), C, keys=["k"])
    right = op.merge_counts(A, op.merge_counts(B, C, keys=["k"]), keys=["k"])
    assert s(left) == s(right) == s(op.merge_counts(C, B, A, keys=["k"]))


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["x", "y"]), st.integers(0, 5)), max_size=20), st.integers(1, 3))
def test_top_k_is_subset_with_rank_at_most_k(spark, rows, k):
    df = spark.createDataFrame(rows, "g string, v bigint")
    top = op.top_k_per_group(df, ["g"], [F.desc("v")], k, ties=True).collect()
    assert all(r.rk <= k for r in top)
    for g in {r[0] for r in rows}:
        vals = sorted((v for gg, v in rows if gg == g), reverse=True)
        cutoff = vals[min(k, len(vals)) - 1]
        assert sorted(r.v for r in top if r.g == g) == sorted(v for v in vals if v >= cutoff)


ids = st.lists(st.integers(1, 6), min_size=1, max_size=3, unique=True)
action_rows = st.lists(st.tuples(st.one_of(st.just(-1), st.integers(1, 6)),
                                 st.one_of(st.none(), ids), st.one_of(st.none(), ids)), max_size=25)


@SETTINGS
@given(action_rows)
def test_category_counts_equal_brute_force(spark, rows):
    data = [dict(click_category_id=c, click_product_id=(1 if c != -1 else -1),
                 order_category_ids=None if o is None else ",".join(map(str, o)),
                 pay_category_ids=None if p is None else ",".join(map(str, p))) for c, o, p in rows]
    got = sorted(map(tuple, op.category_action_counts(h.visits(spark, data))
                     .select("category_id", "click_count", "order_count", "pay_count").collect()))
    want = defaultdict(lambda: [0, 0, 0])
    for c, o, p in rows:                       # first match wins: click, else order, else pay
        if c != -1:
            want[c][0] += 1
        elif o is not None:
            for x in o:
                want[x][1] += 1
        elif p is not None:
            for x in p:
                want[x][2] += 1
    assert got == sorted((k, *v) for k, v in want.items())
