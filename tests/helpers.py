"""Small builders for hand fixtures."""

from clickpulse.schemas import AD_CLICKS, CITIES, PRODUCTS, USERS, VISITS

_VISIT_DEFAULTS = dict(date="2019-11-26", user_id=1, session_id="s1", page_id=1,
                       action_time="2019-11-26 10:00:00", search_keyword=None,
                       click_category_id=-1, click_product_id=-1, order_category_ids=None,
                       order_product_ids=None, pay_category_ids=None, pay_product_ids=None,
                       city_id=1, event_id=0)


def visits(spark, rows):
    out = []
    for i, r in enumerate(rows):
        d = dict(_VISIT_DEFAULTS, event_id=i)
        d.update(r)
        out.append(tuple(d[f.name] for f in VISITS.fields))
    return spark.createDataFrame(out, VISITS)


def users(spark, rows):
    return spark.createDataFrame(rows, USERS)


def cities(spark, rows):
    return spark.createDataFrame(rows, CITIES)


def products(spark, rows):
    return spark.createDataFrame(rows, PRODUCTS)


def clicks(spark, rows, with_id=True):
    """rows: (ts_ms, area, city, userid, adid); event_id = position."""
    if with_id:
        data = [(i,) + tuple(r) for i, r in enumerate(rows)]
        return spark.createDataFrame(data, "event_id BIGINT, " + ", ".join(
            f"{f.name} {f.dataType.simpleString()}" for f in AD_CLICKS.fields))
    return spark.createDataFrame(rows, AD_CLICKS)


def ms(ts: str) -> int:
    """'yyyy-MM-dd HH:mm:ss[.fff]' (UTC) -> epoch milliseconds."""
    import datetime as dt
    fmt = "%Y-%m-%d %H:%M:%S.%f" if "." in ts else "%Y-%m-%d %H:%M:%S"
    t = dt.datetime.strptime(ts, fmt).replace(tzinfo=dt.timezone.utc)
    return int(t.timestamp() * 1000)
