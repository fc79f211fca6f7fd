"""Q0: the visit log of known users, narrowed by optional parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame

from clickpulse.functions.predicates import all_of, optional_predicates
from clickpulse.schemas import VISITS

USER_COLUMNS = ("age", "professional", "gender")


def filtered_visits(visits: DataFrame, users: DataFrame, params: dict | None = None,
                    cities: DataFrame | None = None) -> DataFrame:
    """Visits joined to users (visits of unknown users drop out), filtered by
    every non-empty parameter, returned with the visit columns only.

    Catalyst pushes the date predicates into the visit scan and the age /
    profession / gender predicates into the user side before the join.
    ``city`` needs ``cities`` (city names are resolved through ``city_id``).
    """
    params = params or {}
    u = users.select("user_id", *USER_COLUMNS)
    joined = visits.join(u, "user_id")
    if params.get("city"):
        if cities is None:
            raise ValueError("the 'city' parameter needs the cities table")
        joined = joined.join(cities.select("city_id", "city_name"), "city_id")
    cols = [f.name for f in VISITS.fields if f.name in visits.columns]
    return joined.where(all_of(optional_predicates(params))).select(*cols)
