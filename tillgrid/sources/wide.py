"""Wide monthly exports: schema generation, reading, parsing and unpivot.

A sales sheet has one row per product line and three columns per month
(``jan_order, jan_qty, jan_amt`` ...), optionally followed by a total block.
Header, store-total and grand-total lines go by their place in the sheet, as in the
source: a column ``line`` tells a row's place, so a product without a label, or one
labelled like a total, stays.  Many sheets (one per store and year) are processed as
one DataFrame keyed by ``store_id, year``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import vocab
from ..functions import rules as R
from ..functions.text import collapse_ws, freight_tag, parse_product_name, strip_tags
from . import star
from .reference import file_order
from .tables import Tables

#: The type of an amount cell: wide enough for any sum of a sheet.
AMOUNT = "decimal(28,2)"
CELL_TYPES = {"order": "bigint", "qty": "bigint", "amt": AMOUNT}
SUFFIXES = list(CELL_TYPES)
TOTAL_COLS = ["total_order", "total_qty", "total_amt"]


def months_for(year: int, start: int, end: int) -> list[tuple[str, str]]:
    """[(prefix, 'YYYY-MM')] for months start..end inclusive."""
    if not (1 <= start <= 12 and 1 <= end <= 12) or start > end:
        raise ValueError(f"bad month range {start}..{end}")
    return [(vocab.MONTH_PREFIXES[m - 1], f"{year:04d}-{m:02d}") for m in range(start, end + 1)]


def month_columns(prefixes: list[str]) -> list[str]:
    """The per-month measure columns, in sheet order."""
    return [f"{p}_{s}" for p in prefixes for s in SUFFIXES]


def sheet_schema(label: str, prefixes: list[str], with_total: bool) -> T.StructType:
    """All-string schema generated from the month list."""
    cols = [label] + month_columns(prefixes) + (TOTAL_COLS if with_total else [])
    return T.StructType([T.StructField(c, T.StringType(), True) for c in cols])


def read_sheet_csv(spark: SparkSession, path: str, prefixes: list[str],
                   label: str = "product_name") -> DataFrame:
    """Read a headerless wide CSV export with an all-string schema;
    accepts the two legal widths and rejects anything else."""
    probe = spark.read.option("header", False).csv(path)
    n = len(probe.columns)
    narrow = 1 + 3 * len(prefixes)
    if n == narrow + 3:
        schema = sheet_schema(label, prefixes, True)
    elif n == narrow:
        schema = sheet_schema(label, prefixes, False)
    else:
        raise ValueError(f"sheet has {n} columns; expected {narrow} (no total block) "
                         f"or {narrow + 3} (with one)")
    return (spark.read.option("header", False).option("encoding", "UTF-8").schema(schema)
            .csv(path).select("*", F.col("_metadata.file_path").alias("source_file"),
                              file_order(file=False).alias("line")))


def _num(c: str | Column, typ: str) -> Column:
    return F.replace(F.col(c) if isinstance(c, str) else c, F.lit(","), F.lit("")).try_cast(typ)


def with_total_block(df: DataFrame, prefixes: list[str]) -> DataFrame:
    """Derive the total block as the sum over months when it is absent."""
    if all(c in df.columns for c in TOTAL_COLS):
        return df
    # over the cells that are there, as an array: an expression a cell makes methods too long for the JIT
    for s, typ in CELL_TYPES.items():
        wide = "decimal(38,2)" if typ == AMOUNT else typ
        filled = F.filter(F.array(*[F.col(f"{p}_{s}") for p in prefixes]), lambda x: x.isNotNull())
        total = F.aggregate(filled, F.lit(0).cast(wide), lambda a, x: (
            a + F.coalesce(_num(x, typ), F.lit(0).cast(typ))).cast(wide))
        df = df.withColumn(f"total_{s}", total.cast("string"))
    return df


def bad_cells(df: DataFrame) -> Column:
    """The cells of a line that are not blank and do not parse: structs (cell, value)."""
    names = [(c, typ) for p in [*vocab.MONTH_PREFIXES, "total"] for s, typ in CELL_TYPES.items()
             if (c := f"{p}_{s}") in df.columns]
    cells = F.array(*[F.struct(F.lit(c).alias("cell"), F.col(c).alias("value"),
                               _num(c, typ).isNull().alias("bad")) for c, typ in names])
    return F.filter(cells, lambda x: x["bad"] & (F.trim(x["value"]) != ""))


def rejected_cells(df: DataFrame, key_cols: list[str]) -> DataFrame:
    """Cells that are not blank and do not parse: (keys, cell, value).

    The parse gives NULL for them; ``loads.load_sales_sheets`` stops on any."""
    return (df.select(*key_cols, F.explode(bad_cells(df)).alias("c"))
            .select(*key_cols, "c.cell", "c.value"))


def off_total(df: DataFrame, prefixes: list[str]) -> Column:
    """Q6 line by line: whether the months' amounts miss the line's total by more than the tolerance."""
    amounts = [F.coalesce(_num(f"{p}_amt", AMOUNT), F.lit(0).cast(AMOUNT)) for p in prefixes]
    total = F.coalesce(_num("total_amt", AMOUNT), F.lit(0).cast(AMOUNT))
    return F.abs(reduce(lambda a, b: a + b, amounts) - total) > vocab.RECONCILE_TOLERANCE


#: Lines at the head of a sheet: two headers, and in a sales sheet the store's total.
SALES_HEAD, CHANNEL_HEAD = 3, 2


def body_rows(df: DataFrame, sheet: list[str], head: int) -> DataFrame:
    """Without the first ``head`` lines and the last line of every sheet, by place."""
    place = Window.partitionBy(*sheet).orderBy("line")
    lines = df.select(*sheet, "line")
    heads = (lines.withColumn("_n", F.row_number().over(place)).where(F.col("_n") <= head)
             .groupBy(*sheet).agg(F.max("line").alias("_head")))
    ends = lines.groupBy(*sheet).agg(F.max("line").alias("_last")).join(heads, sheet)
    # one row a sheet: the wide lines stay where they are
    return (df.join(F.broadcast(ends), sheet).where((F.col("line") > F.col("_head")) & (F.col("line") < F.col("_last")))
            .select(*df.columns))


def parse_sales_sheet(df: DataFrame, prefixes: list[str],
                      sheet: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """S1-S2 + P2-P5 + F1: returns (products, excluded_rows).

    products: sku_code, brand, product_desc, freight_tag, <month cols>, totals
    excluded: product_name + totals
    """
    df = with_total_block(body_rows(df, sheet or ["source_file"], SALES_HEAD).drop("line"), prefixes)
    df = df.withColumn("product_name", collapse_ws("product_name"))
    df = df.withColumn("_p", parse_product_name("product_name"))
    non_product = R.is_non_product(F.col("_p.sku_code"))
    keep_cols = [c for c in df.columns if c not in ("product_name", "_p")]
    excluded = df.filter(non_product).select(
        *[c for c in df.columns if c not in month_columns(prefixes) and c != "_p"])
    kept = (df.filter(~non_product)
            .select(F.col("_p.sku_code").alias("sku_code"),
                    F.trim(F.col("_p.brand_raw")).alias("brand"),
                    F.col("_p.product_desc").alias("_desc"), *keep_cols)
            .withColumn("freight_tag", freight_tag("_desc"))
            .withColumn("product_desc", strip_tags("_desc")).drop("_desc"))
    return kept, excluded


def unpivot_sales(products: DataFrame, months: list[tuple[str, str]] | None = None,
                  key_cols: list[str] | None = None, year_col: str | None = None,
                  keep: str | None = None) -> DataFrame:
    """R0 + F5: wide months -> (keys, sku_code, period, order_count, qty, amount),
    dropping cells where order, qty and amount are all blank.

    Either ``months`` gives fixed (prefix, period) pairs, or ``year_col``
    names a column holding the sheet year (all twelve prefixes).  A line whose
    column ``keep`` (one of the keys) is true keeps its blank cells too."""
    keys = key_cols or []
    if months is None:
        months = [(p, f"{i + 1:02d}") for i, p in enumerate(vocab.MONTH_PREFIXES)]
    args = ", ".join(f"'{per}', {p}_order, {p}_qty, {p}_amt" for p, per in months)
    stacked = products.selectExpr(*keys, "sku_code", *([year_col] if year_col else []),
                                  f"stack({len(months)}, {args}) AS (period, o, q, a)")
    if year_col:
        stacked = stacked.withColumn("period", F.concat_ws("-", F.col(year_col).cast("string"),
                                                           "period")).drop(year_col)
    out = stacked.select(*keys, "sku_code", "period",
                         _num("o", "bigint").alias("order_count"), _num("q", "bigint").alias("qty"),
                         _num("a", AMOUNT).alias("amount"))
    some = F.coalesce("order_count", "qty", "amount").isNotNull()
    return out.where(some if keep is None else some | F.col(keep))


# --------------------------------------------------------------------------- fixtures
def _pname(t: Tables) -> DataFrame:
    """Raw product label per part: '[SKUn] [brand]desc{tag}', a '$5 off' line
    for every 97th part, double spaces for every 11th; of every 89 parts one has no
    label and two have those of other lines."""
    p = star.products(t)
    sep = F.when(F.col("partkey") % 11 == 0, F.lit("  ")).otherwise(F.lit(" "))
    tag = F.when(F.col("freight_tag") != "", F.concat(F.lit("{"), F.col("freight_tag"),
                                                      F.lit("}"))).otherwise(F.lit(""))
    odd = F.col("partkey") % 89
    name = (F.when(odd == 5, F.lit(None).cast("string")).when(odd == 6, "Total").when(odd == 7, "Order")
            .when(F.col("partkey") % 97 == 0,
                   F.concat(F.lit("[DIS"), F.col("partkey").cast("string"), F.lit("] $5 off")))
            .otherwise(F.concat(F.lit("["), F.col("sku_code"), F.lit("]"), sep, F.lit("["),
                                F.col("brand"), F.lit("]"), F.col("product_desc"), tag)))
    return p.select("partkey", name.alias("product_name"))


def build_sales_sheets(t: Tables, with_total: bool) -> DataFrame:
    """Wide sales sheets, one per (store, year), from fact_sales (pivot),
    all cells as strings, plus the store-total line and the 'Total' line."""
    f = (star.fact_sales(t)
         .withColumn("year", F.substring("period", 1, 4).cast("int"))
         .withColumn("m", F.substring("period", 6, 2).cast("int")))
    sums = {"total_order": "order_count", "total_qty": "qty", "total_amt": "amount"} if with_total else {}
    # the facts are dealt once, by the key of both the lines and their names, and stay as narrow as they
    # are (a line's few months in a list) until the line is written
    lines = (f.select("partkey", "store_id", "year", "m", "order_count", "qty", "amount").repartition("partkey")
             .groupBy("store_id", "year", "partkey")
             .agg(F.collect_list(F.when(F.col("m").isNotNull(), F.struct(
                 "m", F.struct("order_count", "qty", "amount")))).alias("cells"),
                  *[F.sum(c).cast("string").alias(total) for total, c in sums.items()])
             .join(_pname(t), "partkey").withColumn("line", F.col("partkey") + SALES_HEAD)
             .withColumn("cells", F.map_from_entries("cells")))
    cell = {p: F.element_at("cells", F.lit(i)) for i, p in enumerate(vocab.MONTH_PREFIXES, start=1)}
    lines = lines.select("store_id", "year", "product_name", "line", *sums, *[
        cell[p][c].cast("string").alias(f"{p}_{s}") for p in cell
        for s, c in (("order", "order_count"), ("qty", "qty"), ("amt", "amount"))])
    month_cols = month_columns(vocab.MONTH_PREFIXES) + (TOTAL_COLS if with_total else [])
    store = star.dim_store(t).select("store_id", F.col("store_code").alias("store_label"))
    # header, store-total and grand-total lines: per-sheet sums, straight from the facts
    tot_aggs = []
    for i, p in enumerate(vocab.MONTH_PREFIXES, start=1):
        sel = F.col("m") == i
        tot_aggs += [F.sum(F.when(sel, F.col("order_count"))).cast("string").alias(f"{p}_order"),
                     F.sum(F.when(sel, F.col("qty"))).cast("string").alias(f"{p}_qty"),
                     F.sum(F.when(sel, F.col("amount"))).cast("string").alias(f"{p}_amt")]
    if with_total:
        tot_aggs += [F.sum("order_count").cast("string").alias("total_order"),
                     F.sum("qty").cast("string").alias("total_qty"),
                     F.sum("amount").cast("string").alias("total_amt")]
    frame = _frame([("Column0", 0), (None, 1), ("store_label", 2), ("Total", LAST_LINE)])
    totals = (f.groupBy("store_id", "year").agg(*tot_aggs).join(store, "store_id")
              .select("*", frame).select("*", "frame.*"))
    headed = [F.when(F.col("line") >= 2, F.col(c)).otherwise(
        F.when(F.col("line") == 1, {"order": "Order", "qty": "Product Quantity", "amt": "Total Price"}[c.split("_")[1]]))
        .alias(c) for c in month_cols]
    cols = ["store_id", "year", "product_name", "line"]
    return lines.select(*cols, *month_cols).unionByName(totals.select(*cols, *headed))


#: The place of a derived sheet's last line.
LAST_LINE = 1 << 60


def _frame(lines: list[tuple[str | None, int]]) -> Column:
    """An explode of the lines (label, place) around a sheet's body; the label
    ``store_label`` stands for the column of that name."""
    return F.explode(F.array(*[F.struct(
        (F.col("store_label") if label == "store_label" else F.lit(label).cast("string")).alias("product_name"),
        F.lit(at).cast("long").alias("line")) for label, at in lines])).alias("frame")


def build_channel_sheets(t: Tables) -> DataFrame:
    """Wide channel sheets per (store, year): five channel label rows + 'Total'."""
    f = (star.fact_channel(t)
         .withColumn("year", F.substring("period", 1, 4).cast("int"))
         .withColumn("m", F.substring("period", 6, 2).cast("int")))
    labels = {v: k for k, v in vocab.CHANNEL_CODES.items()}
    label = F.element_at(F.create_map(*[F.lit(x) for kv in labels.items() for x in kv]),
                         F.col("channel_code"))
    aggs = []
    for i, p in enumerate(vocab.MONTH_PREFIXES, start=1):
        sel = F.col("m") == i
        aggs += [F.max(F.when(sel, F.col("order_count"))).cast("string").alias(f"{p}_order"),
                 F.max(F.when(sel, F.col("qty"))).cast("string").alias(f"{p}_qty"),
                 F.max(F.when(sel, F.col("amount"))).cast("string").alias(f"{p}_amt")]
    codes = F.array(*[F.lit(c) for c in vocab.CHANNEL_GROUP])
    line = F.array_position(codes, F.col("channel_code")) + (CHANNEL_HEAD - 1)
    rows = (f.groupBy("store_id", "year", label.alias("channel_name"), line.cast("long").alias("line")).agg(*aggs))
    month_cols = month_columns(vocab.MONTH_PREFIXES)
    sums = [F.sum(F.col(c).cast("decimal(22,2)" if c.endswith("amt") else "bigint"))
            .cast("string").alias(c) for c in month_cols]
    frame = _frame([("Column0", 0), (None, 1), ("Total", LAST_LINE)])
    total = (rows.groupBy("store_id", "year").agg(*sums).select("*", frame)
             .select("*", F.col("frame.product_name").alias("channel_name"), "frame.line"))
    total = total.select("store_id", "year", "channel_name", "line",
                         *[F.when(F.col("line") == LAST_LINE, F.col(c)).alias(c) for c in month_cols])
    cols = ["store_id", "year", "channel_name", "line"] + month_cols
    return rows.select(*cols).unionByName(total.select(*cols))


def parse_channel_sheet(df: DataFrame, key_cols: list[str], year_col: str = "year",
                        sheet: list[str] | None = None, keep: str | None = None) -> DataFrame:
    """S3 + R2 + P16 + F5: channel rows -> (keys, period, channel_code,
    channel_group, order_count, qty, amount)."""
    body = body_rows(df, sheet or [*key_cols, year_col], CHANNEL_HEAD)
    codes = F.create_map(*[F.lit(x) for kv in vocab.CHANNEL_CODES.items() for x in kv])
    groups = F.create_map(*[F.lit(x) for kv in vocab.CHANNEL_GROUP.items() for x in kv])
    body = body.withColumn("sku_code", F.element_at(codes, F.trim("channel_name")))
    long = unpivot_sales(body, key_cols=key_cols, year_col=year_col, keep=keep)
    return (long.withColumnRenamed("sku_code", "channel_code")
            .withColumn("channel_group", F.element_at(groups, F.col("channel_code"))))


def unknown_channel_labels(df: DataFrame, sheet: list[str]) -> DataFrame:
    """Channel lines whose label has no code (the load must abort on any)."""
    return body_rows(df, sheet, CHANNEL_HEAD).where(
        ~F.coalesce(F.trim("channel_name").isin(*vocab.CHANNEL_CODES), F.lit(False)))
