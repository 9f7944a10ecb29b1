"""Order and edit JSON documents: ingest (S1, S2, P1-P4, P10-P12) and a
builder that turns warehouse rows back into documents (the round trip).

Each landed line is one document (one API response).  Parsing is VARIANT end
to end -- ``parse_json``, ``try_variant_get``, ``schema_of_variant`` and
higher-order functions -- so no Python runs per row, and a wrongly typed
element cannot null out its neighbours the way a ``from_json`` schema would.

Order documents: an object whose ``orders`` is an array (a missing ``orders``
is an empty list), or a bare array.  Anything else is a document error.
Elements that are not objects are skipped.  Products follow Python
truthiness (T9):
  * falsy (missing, null, [], {}, 0, 0.0, "", false) -> one placeholder row;
  * an array -> one row per object element (none may remain: order vanishes);
  * a non-empty object or string -> iterates to no row;
  * a non-zero number or true -> the reference raises; here a reject row.

Of a repeated key the last value counts, whatever the session's setting was, and
the bare NaN that some JSON writers emit is a null.

Edit documents: ``query.recentchanges`` must exist (else a document error);
``is_bot`` is key presence (T10); missing or null sizes count as 0 (T11).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import LAKE_EDITS, ORDER_FIELDS, PRODUCT_FIELDS
from ..session import partitions_for

_INTEGRAL = (T.IntegerType, T.LongType)
_NUMERIC_KINDS = ["BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT", "DECIMAL"]


def _members(v: Column, names: list[str]) -> Column:
    """``struct<name: variant, ...>`` view of a VARIANT object; null when ``v``
    is not an object.  One cast checks the shape and splits out every member
    (a missing member is SQL NULL, an explicit JSON null a variant null)."""
    fields = ", ".join(f"`{n}`: variant" for n in names)
    return F.try_variant_get(v, "$", f"struct<{fields}>")


def _is_object(v: Column) -> Column:
    """Whether ``v`` is an object: as a struct without any of its members, since
    every member that is cast to a variant is written anew, with all below it."""
    return F.try_variant_get(v, "$", "struct<`\u0001`: variant>").isNotNull()


def _typed(v: Column, dtype: T.DataType, path: str = "$") -> Column:
    """What ``v`` has at ``path`` cast to ``dtype``; null when missing or unconvertible.
    Integers also accept numbers and text written as 3.0 (through double)."""
    direct = F.try_variant_get(v, path, dtype.simpleString())
    if isinstance(dtype, _INTEGRAL):
        return F.coalesce(direct, F.try_variant_get(v, path, "double").try_cast(dtype))
    return direct


def _as_array(v: Column, path: str = "$") -> Column:
    return F.try_variant_get(v, path, "array<variant>")


def _as_map(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>")


def _scalar_kind(v: Column) -> Column:
    """Type name of a scalar VARIANT (cheap: scalars have no nested schema)."""
    return F.regexp_extract(F.schema_of_variant(v), r"^([A-Z]+)", 1)


def _parsed(docs: DataFrame) -> DataFrame:
    """``(value, v)``: the documents and their VARIANT, null where it is no JSON.  A
    document that fails is tried once more with the numbers that JSON lacks
    rewritten: NaN as null, infinities as text, which casts to them.

    Sets the session to take repeated keys.  The parser notes that setting whenever
    a plan is made or copied, so it has to stay."""
    docs.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    number = r":\s*%s\s*(?=[,}\]])"
    spelled = F.regexp_replace(F.regexp_replace("value", number % "NaN", ":null"), number % "(-?Infinity)", ':"$1"')
    return docs.select("value", F.coalesce(F.try_parse_json("value"), F.try_parse_json(spelled)).alias("v"))


def load_stamp() -> Column:
    """One load time per query, naive UTC whatever the session time zone,
    floored to milliseconds."""
    utc = F.convert_timezone(None, F.lit("UTC"), F.localtimestamp())
    return F.date_trunc("millisecond", utc).cast("timestamp_ntz")


def _explode_each(arr: Column, name: str) -> list[Column]:
    """Generator over ``arr`` that keeps null elements and emits nothing for a
    null or empty array -- like ``explode`` -- but through
    ``posexplode_outer`` followed by a filter on the position.  For an inner
    ``explode`` Catalyst infers ``size(arr) > 0`` and pushes it below the
    projections, which re-runs every VARIANT cast that built ``arr``."""
    return [F.posexplode_outer(arr).alias(f"_{name}_pos", name)]


def _kept(name: str) -> Column:
    return F.col(f"_{name}_pos").isNotNull()


def read_documents(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    """Landed documents as a ``value`` string column (one per line, or one per
    file with ``whole_file``)."""
    return spark.read.text(path, wholetext=whole_file)


# ------------------------------------------------------------------ orders
_ORDER_MEMBERS = [n for n, _ in ORDER_FIELDS] + ["products"]


def _product_shapes(order: Column) -> list[Column]:
    """Shape columns of one order's ``products``, computed once each (a later
    projection references them several times; the optimizer does not inline a
    costly expression that is referenced more than once, whereas inside one
    CASE/OR chain the same cast would run once per reference).  ``_pv`` and
    ``_obj`` are set only where ``products`` is no array."""
    arr = _as_array(order, "$.products")
    pv = F.when(arr.isNull(), F.try_variant_get(order, "$.products", "variant"))
    return [arr.alias("_arr"), pv.alias("_pv"), F.when(arr.isNull(), _as_map(pv)).alias("_obj")]


def _products_or_null() -> Column:
    """From the shape columns: an array of product objects (variants) --
    placeholder, rows or empty -- or NULL where the reference would raise."""
    pv, arr, obj = F.col("_pv"), F.col("_arr"), F.col("_obj")
    # Only scalars need a type name; CASE evaluates the branch lazily, so
    # arrays and objects never pay for a schema walk.
    kind = F.when(arr.isNull() & obj.isNull(), _scalar_kind(pv))
    is_null = arr.isNull() & (pv.isNull() | F.is_variant_null(pv))
    zero_number = kind.isin(*_NUMERIC_KINDS) & (F.try_variant_get(pv, "$", "double") == 0)
    empty_string = (kind == "STRING") & (F.try_variant_get(pv, "$", "string") == "")
    false_value = (kind == "BOOLEAN") & ~F.try_variant_get(pv, "$", "boolean")
    falsy = (is_null | (F.size(arr) == 0) | (F.size(obj) == 0)
             | zero_number | empty_string | false_value)
    return (F.when(F.coalesce(falsy, F.lit(False)), F.array(F.lit(None).cast("variant")))
             .when(arr.isNotNull(), F.filter(arr, _is_object))                   # P3
             .when(obj.isNotNull() | (kind == "STRING"), F.array().cast("array<variant>")))


def ingest_order_documents(docs: DataFrame, ingested_at: Column | None = None,
                           on_error: str = "raise") -> tuple[DataFrame, DataFrame]:
    """Documents (``value`` string) -> (lake item rows R2, rejects).

    ``on_error='raise'`` fails the batch on a document error, as the
    reference does; ``'reject'`` routes the document to the rejects output.
    ``ingested_at`` defaults to the load time floored to milliseconds (P4).

    Documents are split into orders and orders into products, as variants; fields
    are then read by path with their type.  So a value is written anew twice at
    most, whereas a struct of variants at each level would write it at each.  An
    order's fields are read before its products are spread over rows.

    Every costly VARIANT value is produced once: either as the output of a
    generator (``explode``) over arrays already filtered inside higher-order
    functions, or as its own projected column.  Plain filters on aliased
    casts would be pushed below the projection and re-run the cast once per
    reference.
    """
    stamp = ingested_at if ingested_at is not None else load_stamp()
    v, top = F.col("v"), F.col("_top")
    shaped = _parsed(docs).select("value", "v", _is_object(v).alias("_top"))
    shaped = shaped.select("value", "v", "_top", F.when(top, _as_array(v, "$.orders")).otherwise(_as_array(v)).alias("_arr"))
    arr = F.col("_arr")
    # looked up only where there is no array: a missing 'orders' is an empty list
    missing = top & F.when(arr.isNull(), F.try_variant_get(v, "$.orders", "variant").isNull()).otherwise(False)
    err = (F.when(v.isNull(), F.lit("document is not valid JSON"))
            .when(~top & arr.isNull(), F.lit("document must be an object or an array"))
            .when(top & arr.isNull() & ~missing, F.lit("field 'orders' must be an array")))
    if on_error == "raise":
        err = F.when(err.isNotNull(),
                     F.raise_error(F.concat(F.lit("bad order document: "), err)))
    # Order objects (P3: other elements skipped).
    checked = shaped.select("value", err.alias("_err"), F.filter(arr, _is_object).alias("_orders"))
    doc_rejects = checked.filter(F.col("_err").isNotNull()).select(
        F.col("value").alias("document"), F.col("_err").alias("reason"))

    order = F.col("om")
    orders = (checked.select(*_explode_each(F.when(F.col("_err").isNull(), F.col("_orders")), "om"))
                     .filter(_kept("om")))
    fields = [_typed(order, t, f"$.{n}").alias(n) for n, t in ORDER_FIELDS]
    names = [n for n, _ in ORDER_FIELDS]
    refused = (orders.select("om", *_product_shapes(order)).select("om", _products_or_null().alias("_products"))
               .filter(F.col("_products").isNull()))
    order_rejects = refused.select(
        F.to_json(_members(order, _ORDER_MEMBERS)).alias("document"),
        F.lit("products is a truthy scalar (not iterable)").alias("reason"))

    rows = (orders.select(*fields, *_product_shapes(order)).select(*names, _products_or_null().alias("_products"))
                  .select(*names, *_explode_each(F.col("_products"), "pm")).filter(_kept("pm")))
    items = rows.select(*names, *(_typed(F.col("pm"), t, f"$.{n}").alias(n) for n, t in PRODUCT_FIELDS), stamp.alias("ingested_at"))
    return items, doc_rejects.unionByName(order_rejects)


def build_order_documents(items: DataFrame, lines_per_document: int = 1000) -> DataFrame:
    """Warehouse item rows -> order documents (one JSON text per row).

    A document holds one block of at most ``lines_per_document`` consecutive
    rows of one scan partition (``monotonically_increasing_id`` is stable for
    a file scan), grouped by order inside the block -- so every group is
    bounded however many lines one order has; a large order simply spans
    several documents.  Even blocks use the object shape with a
    ``total_orders`` count, odd blocks the bare-array shape; an order without
    lines carries ``products: []`` or ``products: null`` alternately.
    """
    product_struct = F.struct(*[F.col(n) for n, _ in PRODUCT_FIELDS])
    blocks = items.withColumn(
        "_block", F.floor(F.monotonically_increasing_id() / F.lit(lines_per_document)))
    # Explicit hash partitioning on the block: the documents stay spread over
    # the shuffle partitions (AQE would coalesce the few, small document rows
    # into one task, and parsing multiplies each document a thousandfold).
    blocks = blocks.repartition(partitions_for(items), "_block")
    per_order = (blocks.groupBy("_block", *[n for n, _ in ORDER_FIELDS])
                 .agg(F.collect_list(F.when(F.col("product_id").isNotNull(), product_struct))
                       .alias("_products")))
    empty_products = F.when(F.col("order_id") % 2 == 0, F.array().cast(per_order.schema["_products"].dataType))
    order_struct = F.struct(
        *[F.col(n) for n, _ in ORDER_FIELDS],
        F.when(F.size("_products") > 0, F.col("_products")).otherwise(empty_products).alias("products"))
    docs = per_order.groupBy("_block").agg(F.collect_list(order_struct).alias("orders"))
    opts = {"ignoreNullFields": "false"}
    as_object = F.to_json(F.struct(F.size("orders").alias("total_orders"), F.col("orders")), opts)
    as_array = F.to_json(F.col("orders"), opts)
    return docs.select(F.when(F.col("_block") % 2 == 0, as_object).otherwise(as_array).alias("value"))


# ------------------------------------------------------------------- edits
def ingest_edit_documents(docs: DataFrame, on_error: str = "raise") -> tuple[DataFrame, DataFrame]:
    """Edit documents -> (edit lake rows R4, rejects)."""
    changes = F.try_variant_get(F.col("v"), "$.query.recentchanges", "array<variant>")
    err = (F.when(F.col("v").isNull(), F.lit("document is not valid JSON"))
            .when(changes.isNull(), F.lit("missing array query.recentchanges")))
    if on_error == "raise":
        err = F.when(err.isNotNull(), F.raise_error(F.concat(F.lit("bad edit document: "), err)))
    # Each change as a key -> value map (objects only); key presence gives is_bot.
    maps = F.filter(F.transform(changes, _as_map), lambda m: m.isNotNull())
    checked = _parsed(docs).select("value", err.alias("_err"), maps.alias("_changes"))
    rejects = checked.filter(F.col("_err").isNotNull()).select(
        F.col("value").alias("document"), F.col("_err").alias("reason"))
    rc = (checked.select(*_explode_each(F.when(F.col("_err").isNull(), F.col("_changes")), "m"))
                 .filter(_kept("m")))
    m = F.col("m")
    newlen = F.coalesce(_typed(m["newlen"], T.LongType()), F.lit(0))
    oldlen = F.coalesce(_typed(m["oldlen"], T.LongType()), F.lit(0))
    edits = rc.select(
        _typed(m["rcid"], T.LongType()).alias("edit_id"),
        _typed(m["title"], T.StringType()).alias("title"),
        _typed(m["user"], T.StringType()).alias("user"),
        F.map_contains_key(m, "bot").alias("is_bot"),                           # T10
        F.abs(newlen - oldlen).alias("size_diff"),                               # T11
        _typed(m["timestamp"], T.StringType()).alias("timestamp"))
    return edits.select(*[F.col(f.name).cast(f.dataType) for f in LAKE_EDITS.fields]), rejects


def build_edit_documents(spark: SparkSession, sf_dir: str, edits_per_document: int = 500) -> DataFrame:
    """``events`` -> recent-change documents of at most ``edits_per_document``
    edits (the reference's request size).  Bots carry ``"bot": ""``; sizes
    are ``newlen``/``oldlen`` as in the fixture F2."""
    from .fixtures import edit_sizes
    ev = edit_sizes(spark, sf_dir).withColumn(
        "_block", F.floor(F.monotonically_increasing_id() / F.lit(edits_per_document)))
    ev = ev.repartition(partitions_for(ev), "_block")
    change = F.struct(
        F.col("event_id").alias("rcid"),
        F.concat(F.lit("page_"), F.col("user_id").cast("string")).alias("title"),
        F.col("user_id").cast("string").alias("user"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
        F.col("newlen"), F.col("oldlen"),
        F.when(F.col("event_type") == "error", F.lit("")).alias("bot"))
    docs = ev.groupBy("_block").agg(F.collect_list(change).alias("recentchanges"))
    return docs.select(F.to_json(F.struct(F.struct("recentchanges").alias("query"))).alias("value"))


# ------------------------------------------------------------- landing
def land_order_documents(spark: SparkSession, docs_path: str, lake_dir: str,
                         whole_file: bool = False, on_error: str = "raise") -> DataFrame:
    """S1 + S6: landed order documents -> one appended batch of lake rows.

    Like the reference, a payload that yields no row at all is an error.
    Returns the rejects (lazy) for the caller to keep or inspect.
    """
    from .lake import land_items
    items, rejects = ingest_order_documents(read_documents(spark, docs_path, whole_file),
                                            on_error=on_error)
    if items.isEmpty():
        raise ValueError("the order documents hold no order rows")
    land_items(items, lake_dir)
    return rejects


def land_edit_documents(spark: SparkSession, docs_path: str, lake_dir: str,
                        whole_file: bool = False, on_error: str = "raise") -> DataFrame:
    """S2 + S7: landed edit documents -> one appended batch of edit rows."""
    from .lake import land_edits
    edits, rejects = ingest_edit_documents(read_documents(spark, docs_path, whole_file),
                                           on_error=on_error)
    land_edits(edits, lake_dir)
    return rejects


# ------------------------------------------------- registered round trips
def _replaced(docs: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    value = F.col("value")
    for old, new in pairs:
        value = F.replace(value, F.lit(old), F.lit(new))
    return docs.select(value.alias("value"))


def untidy_orders(docs: DataFrame) -> DataFrame:
    """Order documents with what ingest has to take: elements that are no objects
    among orders and products, repeated keys, and NaN for numbers that are missing."""
    return _replaced(docs,
                     ('{"order_id":', '{"order_id":-1,"eval_set":[],"order_id":'),
                     ('[{"order_id":', '[null,"x",7,[],{"order_id":'),
                     ('"products":[{', '"products":[0,null,"y",{'),
                     ('"days_since_prior_order":null', '"days_since_prior_order": NaN'))


def untidy_edits(docs: DataFrame) -> DataFrame:
    """Edit documents with elements that are no objects and repeated keys."""
    return _replaced(docs, ('{"rcid":', '{"title":0,"rcid":'), ('"recentchanges":[', '"recentchanges":[null,"x",[],'))


def _through_files(docs: DataFrame, name: str) -> DataFrame:
    """Documents landed as text, one a line, and read back."""
    from ..session import scratch_path
    path = scratch_path(docs.sparkSession, name)
    docs.write.text(path)
    return read_documents(docs.sparkSession, path)


def ingest_orders_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Warehouse items -> untidy documents in files -> ingest -> clean: equals
    ``order_items``."""
    from ..plans.clean import clean_items
    from ..registry import materialized, order_snapshot
    from ..session import scratch_path
    from .fixtures import fixture_ingested_at
    items = order_snapshot(spark, sf_dir).items
    if not materialized():
        # Blocks number rows of a file scan; a lazy plan ends in shuffles
        # whose row order can change when a task is retried.
        path = scratch_path(spark, "items")
        items.write.parquet(path)
        items = spark.read.schema(items.schema).parquet(path)
    docs = _through_files(untidy_orders(build_order_documents(items)), "order-documents")
    items, _ = ingest_order_documents(docs, ingested_at=fixture_ingested_at())
    return clean_items(items)


def ingest_edits_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` -> untidy edit documents in files -> ingest -> trending: equals
    ``edits_trending``."""
    from ..plans.marts import edits_trending
    docs = _through_files(untidy_edits(build_edit_documents(spark, sf_dir)), "edit-documents")
    edits, _ = ingest_edit_documents(docs)
    return edits_trending(edits)
