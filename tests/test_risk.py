from decimal import ROUND_HALF_UP, Decimal
from itertools import product

import pytest
from conftest import NOW, rows
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructField, StructType

from repovitals import risk_factors, risk_product
from repovitals.operators.risk import category, score_from_factors

NAMES = ("stars_risk_factor", "commits_risk_factor", "contributors_risk_factor", "release_risk_factor", "issues_risk_factor")
WEIGHTS = [Decimal(w) for w in ("0.15", "0.25", "0.20", "0.25", "0.15")]
EVEN = ("0.0", "0.2", "0.4", "0.6", "0.8", "1.0")
FACTORS = (EVEN, EVEN, ("0.0", "0.2", "0.4", "0.6", "1.0"), ("0.0", "0.3", "0.6", "0.8", "1.0"), EVEN)


def test_score_of_every_factor_combination_is_exact(spark):
    combinations = list(product(*([Decimal(f) for f in factors] for factors in FACTORS)))
    assert len(combinations) == 5400
    schema = StructType([StructField(name, DecimalType(2, 1)) for name in NAMES])
    score = score_from_factors(**{name: F.col(name) for name in NAMES})
    got = spark.createDataFrame(combinations, schema).select(*NAMES, score, category(score)).collect()
    for row in got:
        weighted = sum(f * w for f, w in zip(row[:5], WEIGHTS))
        exact = weighted.quantize(Decimal("0.01"), ROUND_HALF_UP) * 100
        level = "HIGH" if exact >= 70 else "MEDIUM" if exact >= 40 else "LOW"
        assert (row[5], row[6]) == (exact, level)


BANDS = {
    "stars": ("stars_risk_factor", [(None, 1.0), (-1, 1.0), (0, 1.0), (1, 0.8), (9, 0.8), (10, 0.6), (11, 0.6), (99, 0.6),
              (100, 0.4), (101, 0.4), (999, 0.4), (1000, 0.2), (1001, 0.2), (9999, 0.2), (10000, 0.0), (10001, 0.0)]),
    "commits_90d": ("commits_risk_factor", [(None, 1.0), (-1, 1.0), (0, 1.0), (1, 0.8), (4, 0.8), (5, 0.6), (6, 0.6), (19, 0.6),
                    (20, 0.4), (21, 0.4), (49, 0.4), (50, 0.2), (51, 0.2), (99, 0.2), (100, 0.0), (101, 0.0)]),
    "active_contributors_90d": ("contributors_risk_factor", [(None, 1.0), (0, 1.0), (1, 0.6), (2, 0.6), (3, 0.4), (4, 0.4),
                                (5, 0.2), (6, 0.2), (9, 0.2), (10, 0.0), (11, 0.0)]),
    "days_since_last_release": ("release_risk_factor", [(None, 1.0), (-1, 0.0), (30, 0.0), (31, 0.3), (90, 0.3), (91, 0.6),
                                (180, 0.6), (181, 0.8), (365, 0.8), (366, 1.0), (999, 1.0)]),
    "open_issues": ("issues_risk_factor", [(None, 1.0), (-1, 0.2), (0, 0.0), (1, 0.2), (5, 0.2), (6, 0.4), (10, 0.4), (11, 0.6),
                    (20, 0.6), (21, 0.8), (50, 0.8), (51, 1.0)]),
}


@pytest.mark.parametrize("column", BANDS)
def test_band_edges(frame, column):
    factor, cases = BANDS[column]
    df = frame("repo_entryline", [{"full_name": str(i), column: value} for i, (value, _) in enumerate(cases)])
    got = {row.full_name: row[factor] for row in risk_factors(df).collect()}
    assert [got[str(i)] for i in range(len(cases))] == [expected for _, expected in cases]


def test_product_columns_and_half_point_rounding(frame, as_of):
    # .075 + .25 + .2 + .15 x 1.0: the release factor 0.3 gives a sum ending in half a point.
    row = {"full_name": "a", "language": "Go", "stars": 0, "commits_90d": 0, "active_contributors_90d": 0,
           "days_since_last_release": 90, "open_issues": 51}
    other = {**row, "full_name": "b", "data_source": "git_lab"}
    df = risk_product(frame("repo_entryline", [row, other]), as_of)
    assert rows(df) == [("git_hub", "a", "Go", 0, 0, 0, 90, 51, 83.0, "HIGH", NOW)]
