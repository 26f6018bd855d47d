"""The preparations of the house price, credit and passenger studies."""

from __future__ import annotations

from pyspark.sql import functions as F

from brambling.functions import columns as C
from brambling.operators import cleanse
from brambling.plans.prepare import Recipe

# The rank each priority text stands for.
PRIORITY_RANK = {"1-URGENT": 1.0, "2-HIGH": 2.0, "3-MEDIUM": 3.0, "4-NOT SPECIFIED": 4.0, "5-LOW": 5.0}
STATUS_TARGET = {"F": 0, "O": 1}


def _house_rules(df):
    return (cleanse.dedupe_rows(cleanse.filter_positive(df, "price"))
            .withColumns({"season": C.season(F.month("sold_at")), "quantity_ratio": C.ratio(F.col("quantity"), F.col("size"))}))


def house(caps: dict | None = None) -> Recipe:
    """Sales: season, size ratio, brand coded by mean price, everything scaled; optionally capped."""
    return Recipe(keep=("sale_id", "line", "price"), target="price",
                  numeric=("quantity", "size", "retail", "quantity_ratio", "brand_code"), categorical=("season",),
                  ordinal=("brand",), impute=("brand_code",), caps=caps or {}, rules=_house_rules)


def _credit_rules(df):
    return (cleanse.filter_in(df, "loan_status", list(STATUS_TARGET))
            .withColumns({"target": C.map_values(F.col("loan_status"), STATUS_TARGET),
                          "rank": C.map_values(F.col("priority"), PRIORITY_RANK),
                          "years": C.years_between(F.lit("2020-01-01").cast("date"), F.col("issued")).cast("double")}))


_CREDIT = dict(keep=("loan_id", "target"), target="target", numeric=("amount", "balance", "rank", "years", "nation_ratio"),
               categorical=("segment",), class_ratio=("nation",), impute=("amount", "balance", "nation_ratio"))


def credit() -> Recipe:
    """Loans: mapped rank, age in years, nation coded by class ratio, medians, scaling."""
    return Recipe(**_CREDIT, rules=_credit_rules)


def credit_limited() -> Recipe:
    """As ``credit`` with the amount capped, the balance limited at both ends and the rank made binary."""
    def rules(df):
        return _credit_rules(df).withColumns({
            "amount": C.cap_max(F.col("amount"), 400000.0),
            "balance": C.winsorize(F.col("balance"), 0.0, 8000.0),
            "rank": C.binarize(F.col("rank"), 3.0).cast("double")})
    return Recipe(**_CREDIT, rules=rules)


def passengers() -> Recipe:
    """Passenger lists: '?' is missing, numbers come as text, medians, scaling, 0/1 columns."""
    def rules(df):
        marked = cleanse.null_tokens(df, ["age", "fare", "port"])
        return cleanse.dedupe_rows(cleanse.cast_schema(marked, {"age": "double", "fare": "double"}))
    return Recipe(keep=("passenger", "survived"), target="survived", numeric=("age", "fare"),
                  categorical=("port",), impute=("age", "fare"), rules=rules)
