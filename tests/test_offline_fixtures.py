"""Hand fixtures with literal expectations for Q0-Q4 (FIXTURES.md section 3)."""

from clickpulse import operators as op
from clickpulse.functions.share import share_text
from tests import helpers as h


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


# -- Q1: action classification and counts ------------------------------------

def test_visits_actions_first_match_and_multi_ids(spark):
    v = h.visits(spark, [
        dict(click_category_id=3, click_product_id=30),
        dict(order_category_ids="1,2,5", order_product_ids="10,20,50"),
        dict(pay_category_ids="2,7", pay_product_ids="20,70"),
        dict(search_keyword="phone"),
        dict(),
        # click and order both set: the click wins (first match)
        dict(click_category_id=3, click_product_id=31, order_category_ids="9"),
    ])
    got = _rows(op.category_action_counts(v), "category_id", "click_count", "order_count", "pay_count")
    assert got == [(1, 0, 1, 0), (2, 0, 1, 1), (3, 2, 0, 0), (5, 0, 1, 0), (7, 0, 0, 1)]


def test_category_ties_lexicographic_order(spark):
    rows = []
    # cat 1: clicks 2, orders 1; cat 2: clicks 2, orders 2; cat 3: clicks 2, orders 2, pays 1
    for cat, clicks, orders, pays in [(1, 2, 1, 0), (2, 2, 2, 0), (3, 2, 2, 1), (4, 3, 0, 0)]:
        rows += [dict(click_category_id=cat, click_product_id=1)] * clicks
        rows += [dict(order_category_ids=str(cat))] * orders
        rows += [dict(pay_category_ids=str(cat))] * pays
    top = op.category_top10(h.visits(spark, rows), n=3).collect()
    assert [r.category_id for r in top] == [4, 3, 2]


def test_category_session_top_ties_cut_by_session_id(spark):
    rows = []
    for s, n in [("s1", 3), ("s2", 2), ("s3", 2), ("s4", 1)]:
        rows += [dict(session_id=s, click_category_id=5, click_product_id=1)] * n
    got = op.category_session_top10(h.visits(spark, rows), n=2).collect()
    assert [(r.category_id, r.session_id, r.click_count) for r in got] == [(5, "s1", 3), (5, "s2", 2)]


# -- Q0: optional filters -------------------------------------------------------

def _q0_inputs(spark):
    v = h.visits(spark, [
        dict(user_id=1, date="2019-11-01", city_id=1, search_keyword="kw_a"),
        dict(user_id=2, date="2019-11-10", city_id=2, click_category_id=4, click_product_id=4),
        dict(user_id=3, date="2019-11-20", city_id=1),
        dict(user_id=99, date="2019-11-10", city_id=1),          # unknown user
    ])
    u = h.users(spark, [(1, "u1", "n1", 25, "teacher", "F"), (2, "u2", "n2", 40, "worker", "M"),
                        (3, "u3", "n3", 55, "teacher", "M")])
    c = h.cities(spark, [(1, "beijing", "north"), (2, "shanghai", "east")])
    return v, u, c


def test_params_each(spark):
    v, u, c = _q0_inputs(spark)

    def users_after(params):
        return sorted(r.user_id for r in op.filtered_visits(v, u, params, cities=c).collect())

    assert users_after({}) == [1, 2, 3]                     # identity on known users
    assert users_after({"startDate": "", "endAge": ""}) == [1, 2, 3]
    assert users_after({"startDate": "2019-11-05"}) == [2, 3]
    assert users_after({"endDate": "2019-11-10"}) == [1, 2]
    assert users_after({"startAge": "30"}) == [2, 3]
    assert users_after({"endAge": "40"}) == [1, 2]
    assert users_after({"professional": "teacher"}) == [1, 3]
    assert users_after({"professionals": "worker"}) == [2]
    assert users_after({"gender": "M"}) == [2, 3]
    assert users_after({"city": "shanghai"}) == [2]
    assert users_after({"keywords": "kw_a"}) == [1]
    assert users_after({"categoryIds": "4"}) == [2]
    assert users_after({"startDate": "2019-11-05", "gender": "M", "endAge": "50"}) == [2]


def test_filtered_visits_keeps_visit_columns(spark):
    v, u, c = _q0_inputs(spark)
    assert op.filtered_visits(v, u, {}).columns == v.columns


# -- Q3: page jumps -----------------------------------------------------------------

def test_session_same_second_uses_event_id(spark):
    v = h.visits(spark, [
        dict(session_id="s", page_id=2, action_time="2019-11-26 10:00:00", event_id=11),
        dict(session_id="s", page_id=1, action_time="2019-11-26 10:00:00", event_id=10),
    ])
    assert _rows(op.page_transitions(v), "from_page", "to_page", "jumps") == [(1, 2, 1)]


def test_jumps_cross_time_slices(spark):
    # pages 1..4 spread over different minutes and hours of one session: every
    # consecutive pair must be found, also across slice boundaries.
    times = ["2019-11-26 10:00:01", "2019-11-26 10:00:59", "2019-11-26 10:07:00", "2019-11-26 13:00:00"]
    v = h.visits(spark, [dict(session_id="s", page_id=i + 1, action_time=t) for i, t in enumerate(times)]
                 + [dict(session_id="t", page_id=4, action_time="2019-11-26 10:00:00"),
                    dict(session_id="t", page_id=1, action_time="2019-11-26 23:00:00")])
    for chars in (16, 13, 19, 10):
        got = _rows(op.page_transitions(v, slice_chars=chars), "from_page", "to_page", "jumps")
        assert got == [(1, 2, 1), (2, 3, 1), (3, 4, 1), (4, 1, 1)], chars


def test_flow_zero_views_and_unseen_pairs(spark):
    v = h.visits(spark, [
        dict(session_id="s", page_id=1, action_time="2019-11-26 10:00:00"),
        dict(session_id="s", page_id=2, action_time="2019-11-26 10:00:01"),
        dict(session_id="s", page_id=1, action_time="2019-11-26 10:00:02"),
    ])
    got = {r.jump: (r.jumps, r.page_views, r.ratio) for r in op.page_jump_ratio(v, "1,2,9,1").collect()}
    assert got == {"1-2": (1, 2, 0.5), "2-9": (0, 1, 0.0), "9-1": (0, 0, None)}
    # a flow that repeats a step reports each jump once
    rows = [(r.jump, r.jumps) for r in op.page_jump_ratio(v, "1,2,1,2").collect()]
    assert sorted(rows) == [("1-2", 1), ("2-1", 1)]


# -- Q4: area top products and the city share text ----------------------------------

def _share(spark, counts, top=2):
    total = sum(c for c, _ in counts)
    df = spark.createDataFrame([(counts, total)], "cc array<struct<c:bigint,city:string>>, n bigint")
    return df.select(share_text("cc", "n", top).alias("t")).first().t


def test_city_share_one_city(spark):
    assert _share(spark, [(7, "beijing")]) == "beijing:100.0%,other:0.0%"


def test_city_share_three_cities_and_rounding(spark):
    assert _share(spark, [(3, "b"), (5, "a"), (2, "c")]) == "a:50.0%,b:30.0%,other:20.0%"
    assert _share(spark, [(1, "a"), (1, "b"), (1, "c")]) == "a:33.3%,b:33.3%,other:33.3%"
    # half up: 1/16 = 6.25% -> 6.3%
    assert _share(spark, [(15, "a"), (1, "b")]) == "a:93.8%,b:6.3%,other:0.0%"


def test_city_share_tie_broken_by_name(spark):
    assert _share(spark, [(2, "beta"), (1, "gamma"), (2, "alpha")]) == "alpha:40.0%,beta:40.0%,other:20.0%"


def _q4_inputs(spark, product_clicks):
    rows = []
    for pid, city, n in product_clicks:
        rows += [dict(click_product_id=pid, click_category_id=1, city_id=city)] * n
    c = h.cities(spark, [(1, "c1", "north"), (2, "c2", "north"), (3, "c3", "south")])
    p = h.products(spark, [(i, f"p{i}", "self") for i in range(1, 10)])
    return h.visits(spark, rows), c, p


def test_rank_ties_keep_all_products(spark):
    v, c, p = _q4_inputs(spark, [(1, 1, 5), (2, 1, 4), (3, 1, 2), (4, 2, 2), (5, 2, 1)])
    got = _rows(op.area_product_top3(v, c, p), "area", "product_id", "product_count", "rk")
    assert got == [("north", 1, 5, 1), ("north", 2, 4, 2), ("north", 3, 2, 3), ("north", 4, 2, 3)]


def test_q4_city_text_and_unknown_keys(spark):
    v, c, p = _q4_inputs(spark, [(1, 1, 3), (1, 2, 1), (1, 3, 2), (8, 1, 1), (12, 1, 9), (2, 77, 4)])
    got = {(r.area, r.product_id): (r.product_name, r.product_count, r.city_click_ratio)
           for r in op.area_product_top3(v, c, p).collect()}
    # product 12 is unknown to products (dropped); city 77 is unknown (its clicks drop out)
    assert got == {("north", 1): ("p1", 4, "c1:75.0%,c2:25.0%,other:0.0%"),
                   ("north", 8): ("p8", 1, "c1:100.0%,other:0.0%"),
                   ("south", 1): ("p1", 2, "c3:100.0%,other:0.0%")}


def test_click_geo_drops_non_clicks_and_unknown_cities(spark):
    v = h.visits(spark, [dict(click_product_id=5, city_id=1), dict(city_id=1),
                         dict(click_product_id=6, city_id=42)])
    c = h.cities(spark, [(1, "c1", "north")])
    assert _rows(op.click_geo(v, c), "area", "city_name", "click_product_id") == [("north", "c1", 5)]
