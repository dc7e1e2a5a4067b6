"""Property tests: Column expressions against plain-Python models on random inputs."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mercato.functions.formatting import format_money
from mercato.functions.money import money_avg
from mercato.functions.text import title_case
from mercato.plans.labels import add_product_labels

SETTINGS = settings(max_examples=15, deadline=None, derandomize=True, database=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
cents = st.integers(min_value=-10**11, max_value=10**11)


@SETTINGS
@given(st.lists(st.lists(cents, min_size=1, max_size=8), min_size=1, max_size=30))
def test_half_up_average_matches_decimal(spark, groups):
    rows = [(g, Decimal(c).scaleb(-2)) for g, values in enumerate(groups) for c in values]
    df = spark.createDataFrame(rows, "g int, p decimal(18,2)")
    got = dict((r[0], r[1]) for r in df.groupBy("g").agg(money_avg("p")).collect())
    for g, values in enumerate(groups):
        exact = (Decimal(sum(values)) / len(values) / 100).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
        assert got[g] == float(exact)


def money_text_model(c: int) -> str:
    """The documented rule on exact cents (half-up, sign after "$")."""
    sign = "-" if c < 0 else ""
    a = abs(c)
    if a >= 100_000_000:
        q = (2 * a + 1_000_000) // 2_000_000
        return f"${sign}{q // 100}.{q % 100:02d}M"
    if a >= 100_000:
        q = (2 * a + 10_000) // 20_000
        return f"${sign}{q // 10}.{q % 10}K"
    return f"${sign}{a // 100}.{a % 100:02d}"


@SETTINGS
@given(st.lists(cents, min_size=1, max_size=40))
def test_format_money_matches_model(spark, values):
    df = spark.createDataFrame([(i, Decimal(c).scaleb(-2)) for i, c in enumerate(values)], "i int, v decimal(18,2)")
    got = dict((r[0], r[1]) for r in df.select("i", format_money("v")).collect())
    assert got == {i: money_text_model(c) for i, c in enumerate(values)}


words = st.text(alphabet="abcXYZáéíóúãõçÁÉÇ0123456789'-_. ", max_size=30)


@SETTINGS
@given(st.lists(words, min_size=1, max_size=30))
def test_title_case_matches_python(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = dict((r[0], r[1]) for r in df.select("i", title_case("t")).collect())
    assert got == {i: t.title() for i, t in enumerate(texts)}


def test_null_ids_never_match(spark):
    products = spark.createDataFrame([(None, "x_en"), (1, "one_en")], "product_id int, product_category_name_english string")
    items = spark.createDataFrame([(None,), (1,)], "product_id int")
    got = sorted((r.product_id is None, r.product_label) for r in add_product_labels(items, products).collect())
    assert got == [(False, "one_en"), (True, None)]
    assert items.join(products, "product_id").filter(F.col("product_id").isNull()).count() == 0
