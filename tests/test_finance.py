"""Loss-ratio arithmetic against Python decimals (HALF_UP, exact)."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lossline.functions.finance import loss_ratio, vs_target

_money = st.decimals(min_value=0, max_value=10**12, places=2, allow_nan=False, allow_infinity=False)
_target = st.decimals(min_value=0, max_value=2, places=4, allow_nan=False, allow_infinity=False)


@settings(max_examples=30, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(_money, _money, _target), min_size=1, max_size=20))
def test_ratio_and_flag_match_decimal_arithmetic(spark, rows):
    schema = T.StructType([T.StructField("incurred", T.DecimalType(24, 2)),
                           T.StructField("premium", T.DecimalType(18, 2)),
                           T.StructField("target", T.DecimalType(5, 4))])
    df = spark.createDataFrame(rows, schema)
    out = df.select(loss_ratio(F.col("incurred"), F.col("premium")).alias("r"), "target") \
            .withColumn("flag", vs_target(F.col("r"), F.col("target"))).collect()
    for (incurred, premium, target), got in zip(rows, out):
        if premium == 0:
            assert got.r is None and got.flag == "UNDER"
            continue
        expected = (incurred / premium).quantize(Decimal("0.0001"), rounding=ROUND_HALF_UP)
        assert got.r == expected
        assert got.flag == ("OVER" if expected > target else "UNDER")
