"""A raw respondent table derived from the driver's ``orders`` table.

The shared test tables are TPC-H-like, not survey files.  This adapter maps
every order to one raw respondent row with the same schema as the raw layer,
so the survey models run unchanged on data whose size grows with the scale
factor.  Each coded answer is a deterministic function of the order's key,
customer, price and date, spread so that every codebook value, the
"don't know"/refused sentinels, NULL, and fractional codes (1.9, 2.5, 3.5,
0.6) all occur.  Weights are whole numbers (``floor(o_totalprice / 10)``)
with some 0, negative and NULL weights, so weighted sums are exact in any
summation order.

No row is filtered, sampled or capped: the modulo arithmetic below only
assigns answer codes, and every order becomes exactly one respondent row.

Two narrow projections, no shuffle: the first computes each hash bucket
once (integer arithmetic on four pruned order columns), the second maps
buckets to codes with a lookup in a literal array.  Both the Spark plan and
the oracle SQL (``CASE`` text) are generated from the same bucket specs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Buckets:
    """``value of the first (bound, value) with h < bound, else otherwise``,
    where ``h = (o_orderkey * a + o_custkey) % p``."""

    a: int
    p: int
    arms: tuple[tuple[int, float | None], ...]
    otherwise: float | None

    @property
    def hash_sql(self) -> str:
        return f"((o_orderkey * {self.a} + o_custkey) % {self.p})"

    def table(self) -> list[float | None]:
        out = []
        for h in range(self.p):
            out.append(next((v for b, v in self.arms if h < b), self.otherwise))
        return out


def _seq(values) -> tuple[tuple[int, float | None], ...]:
    """Arms mapping bucket i to values[i]."""
    return tuple((i + 1, v) for i, v in enumerate(values))


N = None
BUCKETS: dict[str, Buckets] = {
    "diabete4": Buckets(7, 50, ((5, 1), (6, 2), (36, 3), (41, 4), (43, 7), (44, 9), (45, N), (46, 1.9),
                                (47, 2.5), (48, 3.5), (49, 0.6)), 3),
    "prediab2": Buckets(11, 20, ((4, 1), (16, 2), (17, 7), (18, 9)), N),
    "insulin1": Buckets(13, 20, ((3, 1), (15, 2), (16, 7), (17, 9)), N),
    "rfhype6": Buckets(23, 20, ((11, 1), (18, 2), (19, 9)), N),
    "cvdcrhd4": Buckets(29, 20, ((1, 1), (17, 2), (18, 7), (19, 9)), N),
    "exerany2": Buckets(31, 20, ((15, 1), (18, 2), (19, 7)), 9),
    "paindx3": Buckets(37, 10, ((5, 1), (7, 2), (9, 3)), 9),
    "fruit2": Buckets(41, 8, _seq([101, 102, 103, 201, 205, 301, 555]), 777),
    "fruitju2": Buckets(43, 8, _seq([101, 201, 202, 300, 555, 777, 999]), N),
    "vegetab2": Buckets(47, 10, _seq([99, 100, 101, 102, 201, 202, 301, 555, 777]), N),
    "sexvar": Buckets(53, 21, ((10, 1), (20, 2)), N),
    "ageg5yr": Buckets(59, 15, _seq(list(range(1, 15))), N),
    "race1": Buckets(61, 20, ((12, 1), (14, 2), (15, 3), (16, 4), (17, 5), (18, 6), (19, 7)), 9),
    "educa": Buckets(67, 8, _seq([1, 2, 3, 4, 5, 6, 9]), N),
    "income3": Buckets(71, 13, _seq([*range(1, 12), 77]), 99),
    "urbstat": Buckets(73, 10, ((8, 1), (9, 2)), N),
}

# Derived columns: SQL text over the first projection's columns
# (``h_<name>`` hash buckets and the pass-through order columns).
_YEAR = "(2021 + year(o_orderdate) % 3)"
_STATE = "(o_custkey % 61)"
FIRST: dict[str, str] = {
    "o_orderkey": "o_orderkey",
    "o_custkey": "o_custkey",
    "o_totalprice": "o_totalprice",
    "o_orderdate": "o_orderdate",
    "h_bmi_flag": "((o_orderkey * 19 + o_custkey) % 40)",
    "h_bmi": "(1500 + (o_orderkey * 17 + o_custkey) % 3000)",
    "h_weight": "((o_orderkey * 79 + o_custkey) % 97)",
    **{f"h_{k}": b.hash_sql for k, b in BUCKETS.items()},
}
DERIVED: dict[str, str] = {
    "bmi5": "CAST(CASE WHEN h_bmi_flag = 0 THEN 9999 WHEN h_bmi_flag = 1 THEN NULL ELSE h_bmi END AS DOUBLE)",
    "bmi5cat": (
        "CAST(CASE WHEN h_bmi_flag = 0 THEN 9 WHEN h_bmi_flag = 1 THEN NULL WHEN h_bmi < 1850 THEN 1 "
        "WHEN h_bmi < 2500 THEN 2 WHEN h_bmi < 3000 THEN 3 ELSE 4 END AS DOUBLE)"
    ),
    "state": (
        f"CAST(CASE WHEN {_STATE} < 57 THEN {_STATE} + 1 WHEN {_STATE} = 57 THEN 66 "
        f"WHEN {_STATE} = 58 THEN 72 WHEN {_STATE} = 59 THEN 78 ELSE 99 END AS DOUBLE)"
    ),
    "imonth": "CAST(month(o_orderdate) AS DOUBLE)",
    "iyear": f"CAST({_YEAR} AS DOUBLE)",
    "llcpwt": (
        "CAST(CASE WHEN h_weight = 0 THEN 0 WHEN h_weight = 1 THEN NULL WHEN h_weight = 2 THEN -1 "
        "ELSE floor(o_totalprice / 10) END AS DOUBLE)"
    ),
    "ststr": f"CAST({_STATE} * 1000 + o_orderkey % 7 AS DOUBLE)",
    "psu": "CAST(o_custkey AS DOUBLE)",
    "survey_year": f"CAST({_YEAR} AS INT)",
    "loaded_at": "'2024-01-01T06:00:00+00:00'",
}
# racegr3 is a function of race1: 1->1, 2->2, 7->3, 6->5, 9->9, else 4.
RACEGR3_OF_RACE1 = {1: 1, 2: 2, 3: 4, 4: 4, 5: 4, 6: 5, 7: 3, 9: 9}

OUTPUT = ["respondent_id", "diabete4", "prediab2", "insulin1", "bmi5", "bmi5cat", "rfhype6", "cvdcrhd4",
          "exerany2", "paindx3", "fruit2", "fruitju2", "vegetab2", "state", "imonth", "iyear", "sexvar",
          "ageg5yr", "race1", "racegr3", "educa", "income3", "urbstat", "llcpwt", "ststr", "psu",
          "survey_year", "loaded_at"]


def _lookup_sql(h: str, b: Buckets) -> str:
    vals = ", ".join("CAST(NULL AS DOUBLE)" if v is None else f"{float(v)!r}D" for v in b.table())
    return f"element_at(array({vals}), CAST({h} + 1 AS INT))"


def _racegr3_sql() -> str:
    """racegr3 looked up by the race1 bucket (both are functions of it)."""
    vals = []
    for v in BUCKETS["race1"].table():
        g = None if v is None else RACEGR3_OF_RACE1.get(int(v))
        vals.append("CAST(NULL AS DOUBLE)" if g is None else f"{float(g)!r}D")
    return f"element_at(array({', '.join(vals)}), CAST(h_race1 + 1 AS INT))"


def raw_respondents(orders: DataFrame) -> DataFrame:
    """Raw-layer rows (plus a natural ``respondent_id`` key) from orders."""
    first = orders.selectExpr(*[f"{sql} AS {name}" for name, sql in FIRST.items()])
    cols = {"respondent_id": "CAST(o_orderkey + 1 AS BIGINT)"}
    cols.update({k: _lookup_sql(f"h_{k}", b) for k, b in BUCKETS.items()})
    cols.update(DERIVED)
    cols["racegr3"] = _racegr3_sql()
    # A lambda keeps the wide projection out of one fused method (see code_apart_sql).
    cols["psu"] = "get(transform(array(o_custkey), c -> CAST(c AS DOUBLE)), 0)"
    return first.selectExpr(*[f"{cols[c]} AS {c}" for c in OUTPUT])


def _case_sql(h: str, b: Buckets) -> str:
    def lit(v):
        return "NULL" if v is None else repr(float(v))

    arms = " ".join(f"WHEN {h} < {bound} THEN {lit(v)}" for bound, v in b.arms)
    return f"CAST(CASE {arms} ELSE {lit(b.otherwise)} END AS DOUBLE)"


def raw_respondents_sql(source: str = "orders") -> str:
    """The same derivation as SQL text, for the DuckDB oracle."""
    first = ",\n      ".join(f"{sql} AS {name}" for name, sql in FIRST.items())
    race = " ".join(f"WHEN {float(k)} THEN {float(v)}" for k, v in RACEGR3_OF_RACE1.items())
    cols = {"respondent_id": "CAST(o_orderkey + 1 AS BIGINT)"}
    cols.update({k: _case_sql(f"h_{k}", b) for k, b in BUCKETS.items()})
    cols.update(DERIVED)
    second = ",\n    ".join(f"{sql} AS {name}" for name, sql in cols.items())
    out = ", ".join(f"CAST(CASE race1 {race} END AS DOUBLE) AS racegr3" if c == "racegr3" else c for c in OUTPUT)
    return (f"SELECT {out} FROM (SELECT\n    {second}\n  FROM (SELECT\n      {first}\n    FROM {source}) f) s")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_respondents(read_table(spark, sf_dir, "orders"))
