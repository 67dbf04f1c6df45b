"""Express orders: extract, consolidate, dispatch, track."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import contact
from ..functions import fixed_values as fixed
from ..functions.dates import AsOf, in_window, literal, moment, slot_open, text_timestamp
from ..functions.text import key_text, line_key, strip
from ..operators.joins import enrich, not_in_history, with_events
from ..operators.merge import merge_update
from ..operators.quality import split_valid
from ..session import written
from ..sources.buckets import BUCKETS, BucketTable, insert_buckets, update_buckets
from ..sources.schemas import EXPRESS_LINES, ORDER_PRODUCTS, ORDERS, PRODUCT, SENDS, TRACKING
from ..sources.tables import conform, read_or_empty, write_table

HEADER_COLUMNS = (
    "REGION_CLI", "CIUDAD_CLI", "COMUNA_CLI", "COMUNA_DESP", "CORREO_CLI", "DIRECCION_CLI", "DIRECCION_DESP",
    "E_MAIL", "FONO_CLI", "FONO_DESP", "FONO2_DESP", "IDE", "LATITUD", "LONGITUD", "NOMBRE_CLI", "NOMBRE_DESP",
    "NUM_DOC", "NUM_ORDENVENTA", "OBSERVACION", "ORG_LVL_NUMBER",
)
ORDER_COLUMNS = (
    "NOMBRE_CLI", "FONO_CLI", "DIRECCION_CLI", "REGION_CLI", "CIUDAD_CLI", "COMUNA_CLI", "CC_DESPACHA",
    "LATITUD", "LONGITUD",
)
COORDINATE_COLUMNS = ("LATITUD", "LONGITUD", "FLAG_GEOCODIFICADO")


def open_lines(
    detail: DataFrame, as_of: AsOf, origin: int = fixed.EXPRESS_ORIGIN, slots: Sequence[str] = fixed.EXPRESS_SLOTS
) -> DataFrame:
    """Lines of one origin due around ``as_of`` in a slot that is still open."""
    return detail.filter(
        in_window("FECHA_ENTREGA_ORI", as_of, -1, 2, from_open=True)
        & (F.col("CC_ORIGEN") == origin)
        & slot_open("RANGO_HORARIO", as_of, slots)
    )


def express_lines(
    detail: DataFrame, header: DataFrame, events: DataFrame, as_of: AsOf, **filters
) -> DataFrame:
    """Express line extract (B28): prepared at the store, neither blocked nor on its way there.

    The detail is filtered before any join, events are folded to one row per line.
    The active line-stock table adds no column and could only repeat lines, so it
    is not read.
    """
    out = with_events(
        open_lines(detail, as_of, **filters),
        events,
        ["NUM_RESERVA", "NUM_DETALLE"],
        "COD_ESTADO",
        "FECHA_EVENTO",
        require={fixed.EVENT_PREPARED: "_prepared"},
        optional={fixed.EVENT_RESERVED: "_reserved"},
        forbid=[fixed.EVENT_BLOCKED, fixed.EVENT_EN_ROUTE],
    )
    out = enrich(out, header, ["NUM_RESERVA"], [c for c in HEADER_COLUMNS if c in header.columns], what="header")
    out = out.withColumns(
        {
            "COD_EVENTO_RB": F.when(F.col("_reserved").isNotNull(), fixed.EVENT_RESERVED).cast("string"),
            "FECHA_RESERVADO_BODEGA": text_timestamp("_reserved"),
            "COD_EVENTO_PT": F.lit(fixed.EVENT_PREPARED),
            "FECHA_PREPARADO_TIENDA": text_timestamp("_prepared"),
            "NUM_ORDENVENTA2": F.col("NUM_ORDENVENTA") if "NUM_ORDENVENTA" in out.columns else F.lit(None),
            "FECHA_PROCESO": literal(moment(as_of).replace(microsecond=0)),
            "KEY": line_key("NUM_RESERVA", "PRD_LVL_NUMBER", trim=False),
        }
    )
    absent = {f.name: None for f in EXPRESS_LINES.fields if f.name.startswith(("COD_EVENTO_B", "COD_EVENTO_RT"))}
    return conform(out, EXPRESS_LINES, absent)


def order_products(
    lines: DataFrame,
    key: str = "NUM_RESERVA",
    order_by: Sequence[str] = ("FECHA_PROCESO", "KEY"),
    sku: str = "PRD_LVL_NUMBER",
    name: str = "PRD_NAME_FULL",
    quantity: str = "CANTIDAD",
    price: str = "PRECIO",
) -> DataFrame:
    """Products of all orders, one row per line (A2); ``ORDEN_1`` and on give their order within the order."""
    return lines.select(
        key,
        *[F.col(c).alias(f"ORDEN_{i}") for i, c in enumerate(order_by, 1)],
        strip(F.col(sku).cast("string")).alias("sku"),
        strip(F.col(name).cast("string")).alias("nombre"),
        F.col(quantity).cast("double").alias("cantidad"),
        F.col(price).cast("double").alias("precio"),
    )


def nest_products(orders: DataFrame, products: DataFrame, key: str = "NUM_RESERVA") -> DataFrame:
    """Add ``PRODUCTOS``, the product list of each order as JSON, for the orders given and no others.

    A document holds its order's products, so they meet in one row here and nowhere before.
    """
    fields, order = [f.name for f in PRODUCT.fields], sorted(c for c in products.columns if c.startswith("ORDEN_"))
    wanted = products.join(orders.select(key).distinct(), key, "left_semi")
    items = F.transform(
        F.sort_array(F.collect_list(F.struct(*order, *fields))), lambda p: F.struct(*[p[f].alias(f) for f in fields])
    )
    nested = wanted.groupBy(key).agg(F.to_json(items, {"ignoreNullFields": "false"}).alias("PRODUCTOS"))
    return enrich(orders.drop("PRODUCTOS"), nested, [key], ["PRODUCTOS"], expect="unique", what="products")


def consolidate_orders(
    lines: DataFrame,
    as_of: AsOf,
    key: str = "NUM_RESERVA",
    order_by: Sequence[str] = ("FECHA_PROCESO", "KEY"),
    attributes: Sequence[str] = ORDER_COLUMNS,
    quantity: str = "CANTIDAD",
    price: str = "PRECIO",
    money: str = "decimal(18,4)",
) -> DataFrame:
    """Lines to orders (A1): one row per order with its exact total, the attributes of its first line, control flags.

    All of it is partially aggregated, so an order of any size is one row that no
    task has to gather. Its products stay at line grain (``order_products``).

    ``RECHAZO`` names the reason when a line has no quantity or price; such an
    order is to be split off with ``split_valid`` and has no place downstream (G8).
    """
    amount = (F.col(quantity).cast(money) * F.col(price).cast(money)).cast("decimal(38,8)")
    first = F.min(F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_by)],
                           *[F.col(c).alias(c) for c in attributes]))
    bad = F.count_if(F.col(quantity).isNull() | F.col(price).isNull())
    grouped = lines.groupBy(key).agg(
        F.sum(amount).alias("_total"), first.alias("_first"), bad.alias("_bad"), F.count(F.lit(1)).alias("LINEAS")
    )
    return grouped.select(
        key,
        literal(as_of).alias("FECHA_CREACION"),
        *[F.col("_first")[c].alias(c) for c in attributes],
        F.col("_total").cast("double").alias("TOTAL"),
        F.lit(False).alias("ENVIADO"),
        F.lit(False).alias("FLAG_GEOCODIFICADO"),
        "LINEAS",
        F.when(F.col("_bad") > 0, "cantidad o precio sin valor").alias("RECHAZO"),
    )


def with_coords(orders: DataFrame, geocode_nulls: bool = False) -> DataFrame:
    """Orders with both coordinates written (F14); all of them when missing ones are geocoded too."""
    return orders if geocode_nulls else orders.na.drop("any", subset=["LATITUD", "LONGITUD"])


def _clean(orders: DataFrame) -> DataFrame:
    lat, lng = contact.clean_coords("LATITUD", "LONGITUD")
    return orders.withColumns(
        {"_lat": lat, "_lng": lng, "DIRECCION_GEO": contact.geocode_text("DIRECCION_CLI", "COMUNA_CLI", "CIUDAD_CLI")}
    )


def geocode_worklist(orders: DataFrame) -> DataFrame:
    """Distinct address texts of the orders without usable coordinates, to be sent to a geocoder."""
    return _clean(orders).filter(F.col("_lat").isNull()).select("DIRECCION_GEO").distinct()


def apply_geocodes(orders: DataFrame, answers: DataFrame) -> DataFrame:
    """Final coordinates: the order's own, else the geocoder's answer for its address text.

    answers: ``DIRECCION_GEO, lat, lng``, one row per address.
    """
    out = enrich(_clean(orders), answers, ["DIRECCION_GEO"], {"lat": "_geo_lat", "lng": "_geo_lng"}, what="geocodes")
    own = F.col("_lat").isNotNull()
    both = F.col("_geo_lat").isNotNull() & F.col("_geo_lng").isNotNull()

    def pick(mine, found):
        return contact.dispatch_precision(F.when(own, F.col(mine)).when(both, F.col(found)))

    return out.withColumns(
        {"lat": pick("_lat", "_geo_lat"), "lng": pick("_lng", "_geo_lng"), "FLAG_GEOCODIFICADO": ~own & both}
    ).drop("_lat", "_lng", "_geo_lat", "_geo_lng")


def clean_products(products: Column | str) -> Column:
    """Product list of the dispatch document: blank skus dropped, whole units and prices."""
    parsed = F.from_json(products, T.ArrayType(PRODUCT))
    kept = F.filter(parsed, lambda p: F.coalesce(strip(p["sku"]) != "", F.lit(False)))

    def item(p):
        sku, label = F.regexp_replace(p["sku"], " ", ""), strip(p["nombre"])
        return F.struct(
            strip(sku).alias("product_id"),
            label.alias("name"),
            label.alias("description"),
            F.coalesce(p["cantidad"], F.lit(0.0)).cast("bigint").alias("units"),
            strip(sku).alias("ean"),
            F.coalesce(p["precio"], F.lit(0.0)).cast("bigint").alias("unit_price"),
        )

    return F.transform(kept, item)


def order_document(orders: DataFrame, default_email: str | None = None) -> Column:
    """Dispatch document as JSON text (B22). Columns an earlier stage does not carry take their default.

    The two action points have different keys, so they are written one by one.
    """

    def optional(name, default=None):
        return F.col(name) if name in orders.columns else F.lit(default).cast("string")

    first, last = contact.split_name("NOMBRE_CLI")
    products = clean_products("PRODUCTOS")
    no_products = F.slice(products, 1, 0)

    def text(*fields):
        return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})

    head = text(
        F.col("TOTAL").cast("bigint").alias("total_value"),
        F.lit(0).alias("user_tip"),
        F.lit(fixed.DISPATCH_VEHICLE).alias("vehicle_type"),
        F.lit(fixed.DISPATCH_PAYMENT).alias("payment_method"),
        F.col("NUM_RESERVA").try_cast("bigint").alias("order_id"),
        F.col("IDCARGO").alias("in_store_reference_id"),
    )
    pick_up = text(
        F.col("IDCARGO").alias("picking_point_id"),
        F.lit("").alias("instructions"),
        products.alias("products"),
        F.lit("PICK_UP").alias("action_type"),
        F.lit("STORE").alias("location_type"),
    )
    drop_off = text(
        no_products.alias("products"), F.lit("DROP_OFF").alias("action_type"), F.lit("CLIENT").alias("location_type")
    )
    client = text(
        optional("E_MAIL", default_email).alias("email"),
        F.col("FONO_CLI").cast("string").alias("phone"),
        first.alias("first_name"),
        last.alias("last_name"),
        F.col("DIRECCION_CLI").alias("address"),
        F.col("lat").alias("lat"),
        F.col("lng").alias("lng"),
        optional("OBSERVACION", "").alias("complement"),
        F.col("CIUDAD_CLI").alias("city"),
        optional("OBSERVACION", "").alias("comments"),
        F.col("UBIGEO").cast("string").alias("zip_code"),
    )
    return F.concat(
        F.regexp_replace(head, r"\}$", ""), F.lit(',"action_points":['), pick_up, F.lit(","), drop_off,
        F.lit('],"client_info":'), client, F.lit("}"),
    )


def enrich_orders(orders: DataFrame, districts: DataFrame, stores: DataFrame) -> DataFrame:
    """District code on three trimmed texts, store cargo id on the numeric store code."""
    out = enrich(
        orders, districts, [("REGION_CLI", "region"), ("CIUDAD_CLI", "city"), ("COMUNA_CLI", "district")],
        ["UBIGEO"], normalise=lambda c: strip(c.cast("string")), what="districts",
    )
    return enrich(out, stores, [("CC_DESPACHA", "CC")], ["IDCARGO"], cast="double", what="stores")


def dispatch_outbox(
    orders: DataFrame,
    sends: DataFrame,
    districts: DataFrame,
    stores: DataFrame,
    geocodes: DataFrame,
    as_of: AsOf,
    geocode_nulls: bool = False,
    default_email: str | None = None,
    products: DataFrame | None = None,
) -> DataFrame:
    """Orders to dispatch now (B23): not accepted before, enriched, located, with their document.

    ``products`` has the orders' products at line grain (``order_products``); without
    it the orders carry them as JSON in ``PRODUCTOS``.

    An order that could not be located carries the geocoder error state and no document.
    """
    ready = not_in_history(
        with_coords(orders, geocode_nulls), sends, "NUM_RESERVA",
        where=F.col("STATUS").cast("string").isin(*fixed.ACCEPTED_STATUS),
    )
    out = apply_geocodes(enrich_orders(ready, districts, stores), geocodes)
    if products is not None:
        out = nest_products(out, products)
    located = F.col("lat").isNotNull()
    document = order_document(out, default_email)
    return out.withColumns(
        {
            "FECHA_ENVIO": literal(moment(as_of)),
            "STATUS": F.when(~located, fixed.SEND_GEOCODE_ERROR),
            "PAYLOAD": F.when(located, document),
        }
    )


def sent_coords(outbox: DataFrame) -> DataFrame:
    """Dispatched coordinates and geocode flag of each order."""
    return outbox.select(
        F.col("NUM_RESERVA").cast("string").alias("NUM_RESERVA"),
        F.coalesce(F.col("lat").cast("string"), F.col("LATITUD").cast("string")).alias("LATITUD"),
        F.coalesce(F.col("lng").cast("string"), F.col("LONGITUD").cast("string")).alias("LONGITUD"),
        "FLAG_GEOCODIFICADO",
    )


def update_sent_coords(orders: DataFrame, outbox: DataFrame) -> DataFrame:
    """Write the dispatched coordinates and the geocode flag back to the orders (M2)."""
    return merge_update(orders, sent_coords(outbox), ["NUM_RESERVA"], COORDINATE_COLUMNS, on_dup="unique")


def classify_sends(sends: DataFrame, keep_unreadable: bool = False) -> DataFrame:
    """State of each send out of its status and response text.

    Sends whose stored document is no JSON object are left out (G16), or kept as
    errors with ``keep_unreadable``.
    """
    readable = F.json_object_keys("PAYLOAD").isNotNull()

    def answer(field):
        return F.nullif(F.get_json_object("RESPONSE", f"$.{field}"), F.lit(""))

    url = F.coalesce(answer("tracking_url"), answer("trackingUrl"))
    accepted = F.col("STATUS").cast("string").isin(*fixed.ACCEPTED_STATUS)
    if keep_unreadable:
        accepted = accepted & F.coalesce(readable, F.lit(False))
    else:
        sends = sends.filter(readable)
    return sends.select(
        "NUM_RESERVA",
        "FECHA_ENVIO",
        F.col("STATUS").cast("string").alias("STATUS_API"),
        F.when(accepted & url.isNotNull(), fixed.SEND_OK)
        .when(accepted, fixed.SEND_NO_TRACKING)
        .otherwise(fixed.SEND_ERROR)
        .alias("ESTADO"),
        url.alias("TRACKING_URL"),
        F.get_json_object("PAYLOAD", "$.total_value").try_cast("double").alias("TOTAL"),
    )


def new_tracking(classified: DataFrame, tracking: DataFrame) -> DataFrame:
    """Classified sends whose order has no tracking yet; several sends of one new order all stay."""
    return not_in_history(classified, tracking, "NUM_RESERVA")


def digest(tracking: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Lines of the message about tracked orders, one row each, with the columns ``by`` that name a message (A5).

    The sink joins the lines of a message under ``DIGEST_TITLE``; here none is gathered.
    """
    found = tracking.filter((F.col("ESTADO") == fixed.SEND_OK) & F.col("TRACKING_URL").isNotNull())
    return found.select(*by, F.concat(F.lit("Reserva: "), key_text("NUM_RESERVA"), F.lit("\nTracking: "), "TRACKING_URL").alias("linea"))


def orders_table(path: str, buckets: int = BUCKETS) -> BucketTable:
    return BucketTable(path, ORDERS, ("NUM_RESERVA",), buckets)


def products_table(path: str, buckets: int = BUCKETS) -> BucketTable:
    return BucketTable(path, ORDER_PRODUCTS, ("NUM_RESERVA",), buckets)


def run_orders(spark: SparkSession, lines: DataFrame, orders: BucketTable, products: BucketTable, as_of: AsOf) -> DataFrame:
    """Consolidation over stored tables: orders not known yet and their products are added; returns the rejected orders."""
    lines = written(lines, "express-lines")
    found = written(consolidate_orders(lines, as_of), "express-orders")
    good, rejected = split_valid(found, F.col("RECHAZO").isNull())
    fresh = conform(order_products(lines).join(good.select("NUM_RESERVA"), "NUM_RESERVA", "left_semi"), ORDER_PRODUCTS)
    insert_buckets(products, fresh, on_dup="keep_all")
    insert_buckets(orders, conform(good, ORDERS), on_dup="unique")
    return rejected


def run_dispatch(
    spark: SparkSession, orders: BucketTable, products: BucketTable, sends_path: str, districts: DataFrame, stores: DataFrame,
    geocodes: DataFrame, as_of: AsOf, send: Callable[[DataFrame], DataFrame], **options,
) -> None:
    """Dispatch over stored tables: what ``send`` answers to the outbox is appended to the log, coordinates go back to the orders.

    ``send`` is the courier's client: it takes the outbox and returns it with STATUS and RESPONSE. What the log
    has is not sent again. Coordinates are written back from the outbox, and only in the buckets of its orders.
    """
    sends = read_or_empty(spark, sends_path, SENDS)
    out = dispatch_outbox(orders.read(spark), sends, districts, stores, geocodes, as_of, products=products.read(spark), **options)
    outbox = written(out, "outbox")
    answered = send(outbox.filter(F.col("PAYLOAD").isNotNull())).unionByName(
        outbox.filter(F.col("PAYLOAD").isNull()).withColumn("RESPONSE", F.lit(None).cast("string")), allowMissingColumns=True
    )
    update_buckets(orders, sent_coords(outbox), COORDINATE_COLUMNS, on_dup="unique")
    write_table(conform(answered, SENDS, dict.fromkeys(("STATUS", "PAYLOAD", "RESPONSE"))), sends_path, "append")


def run_tracking(spark: SparkSession, sends_path: str, tracking_path: str) -> None:
    """Tracking over stored tables: states of the sends whose order has none yet are appended."""
    tracking = read_or_empty(spark, tracking_path, TRACKING)
    fresh = new_tracking(classify_sends(read_or_empty(spark, sends_path, SENDS)), tracking)
    write_table(fresh.select(*TRACKING.fieldNames()), tracking_path, "append")
