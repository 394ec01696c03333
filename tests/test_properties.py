"""Property-based tests (hypothesis) of the distributed operators."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillgrid.functions.numeric import mom_list
from tillgrid.operators import ranking
from tillgrid.sources import wide

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(sizes=st.lists(st.integers(min_value=1, max_value=60), min_size=1, max_size=4),
       parts=st.integers(min_value=1, max_value=9), k=st.sampled_from([3, 10]),
       seed=st.integers(min_value=0, max_value=10_000))
def test_ranged_ntile_matches_ntile(spark, sizes, parts, k, seed):
    import random
    rnd = random.Random(seed)
    rows = [(g, f"s{i:03d}", float(rnd.randint(0, 5))) for g, n in enumerate(sizes)
            for i in range(n)]
    df = spark.createDataFrame(rows, "g int, sku string, v double")
    got = ranking.ranged_ntile(df, ["g"], [F.desc("v"), F.asc("sku")], k, out="t",
                               num_partitions=parts)
    want = df.withColumn("t", F.ntile(k).over(Window.partitionBy("g").orderBy(F.desc("v"),
                                                                             F.asc("sku"))))
    assert sorted(got.collect()) == sorted(want.collect())


def _mom_py(series):
    out = []
    for prev, cur in zip(series, series[1:]):
        if prev == 0:
            out.append(0.0)
        else:
            x = Decimal(repr((cur - prev) * 100.0 / prev))
            out.append(float(x.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)))
    return out


@SETTINGS
@given(series=st.lists(st.integers(min_value=0, max_value=10_000).map(lambda v: v / 4),
                       min_size=0, max_size=6))
def test_mom_list_matches_definition(spark, series):
    df = spark.createDataFrame([(series,)], "s array<double>")
    got = df.select(mom_list(F.col("s")).alias("m")).first()["m"]
    assert got == _mom_py(series)


@SETTINGS
@given(cells=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 50)),
                                st.one_of(st.none(), st.integers(0, 99_999))),
                      min_size=1, max_size=12))
def test_unpivot_conserves_money_and_drops_empty_cells(spark, cells):
    months = wide.months_for(2026, 1, 3)
    rows = []
    for i, (q, cents) in enumerate(cells):
        vals = []
        for m in range(3):
            qq = q if (i + m) % 2 == 0 else None
            aa = None if cents is None or (i + m) % 3 == 0 else f"{cents / 100:.2f}"
            vals += [None if qq is None else str(qq), None if qq is None else str(qq), aa]
        rows.append((f"SKU{i}", *vals))
    cols = ["sku_code"] + wide.month_columns([p for p, _ in months])
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))
    long = wide.unpivot_sales(df, months).collect()
    want_amt = sum(Decimal(v) for r in rows for v in r[3::3] if v is not None)
    assert sum((r.amount or Decimal(0)) for r in long) == want_amt
    nonempty = sum(1 for r in rows for j in range(3) if any(r[1 + 3 * j + x] is not None
                                                           for x in range(3)))
    assert len(long) == nonempty
