"""Declared schemas of the pipeline tables."""

from __future__ import annotations

from pyspark.sql import types as T

_TEXT = T.StringType()
_LONG = T.LongType()
_NUMBER = T.DoubleType()
_FLAG = T.BooleanType()
_DAY = T.DateType()
_LOCAL = T.TimestampNTZType()
_INSTANT = T.TimestampType()


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


def _texts(*names: str) -> dict[str, T.DataType]:
    return dict.fromkeys(names, _TEXT)


EXPRESS_LINES = _schema(
    CANTIDAD=_NUMBER, CC_DESPACHA=_LONG, CC_ORIGEN=_LONG,
    **_texts(
        "REGION_CLI", "CIUDAD_CLI", "COMUNA_CLI", "COMUNA_DESP", "CORREO_CLI", "DIRECCION_CLI",
        "DIRECCION_DESP", "E_MAIL", "COD_EVENTO_B", "FECHA_BLOQUEADO", "COD_EVENTO_RB",
        "FECHA_RESERVADO_BODEGA", "COD_EVENTO_RT", "FECHA_EN_RUTA_TIENDA",
    ),
    COD_EVENTO_PT=_LONG,
    **_texts(
        "FECHA_PREPARADO_TIENDA", "EXPRESS", "FONO_CLI", "FONO_DESP", "FONO2_DESP", "IDE", "LATITUD",
        "LONGITUD", "NOMBRE_CLI", "NOMBRE_DESP", "NUM_DOC", "NUM_ORDENVENTA", "NUM_ORDENVENTA2",
        "NUM_RESERVA", "OBSERVACION", "ORG_LVL_NUMBER", "PRD_LVL_NUMBER", "PRD_NAME_FULL",
    ),
    PRECIO=_NUMBER, RANGO_HORARIO=_TEXT, FECHA_ENTREGA_ORI=_LOCAL, FECHA_PROCESO=_LOCAL, KEY=_TEXT,
)

ORDERS = _schema(
    NUM_RESERVA=_TEXT, FECHA_CREACION=_LOCAL,
    **_texts("NOMBRE_CLI", "FONO_CLI", "DIRECCION_CLI", "REGION_CLI", "CIUDAD_CLI", "COMUNA_CLI"),
    CC_DESPACHA=_LONG, LATITUD=_TEXT, LONGITUD=_TEXT, TOTAL=_NUMBER,
    ENVIADO=_FLAG, FLAG_GEOCODIFICADO=_FLAG,
)

#: Products at line grain; ``ORDEN_1`` and ``ORDEN_2`` are the default order of an order's lines.
ORDER_PRODUCTS = _schema(
    NUM_RESERVA=_TEXT, ORDEN_1=_LOCAL, ORDEN_2=_TEXT, sku=_TEXT, nombre=_TEXT, cantidad=_NUMBER, precio=_NUMBER
)

SENDS = _schema(NUM_RESERVA=_TEXT, FECHA_ENVIO=_LOCAL, STATUS=_TEXT, PAYLOAD=_TEXT, RESPONSE=_TEXT)

TRACKING = _schema(
    NUM_RESERVA=_TEXT, FECHA_ENVIO=_LOCAL, STATUS_API=_TEXT, ESTADO=_TEXT, TRACKING_URL=_TEXT, TOTAL=_NUMBER
)

TRACKER_LINES = _schema(
    KEY=_TEXT, NUM_RESERVA=_LONG, PRD_LVL_NUMBER=_TEXT, PRD_NAME_FULL=_TEXT, CC_ORIGEN=_LONG,
    CC_DESPACHA=_LONG, PRD_KILO=_NUMBER, PRD_M3=_NUMBER, TIPO_STOCK=_TEXT, IDE_CHOFER=_LONG,
    IDE_DV_CHOFER=_TEXT, NOMBRE_CHOFER=_TEXT, CANT_DESP=_LONG, FECHA_REPARTO=_LOCAL,
    FECHA_PREPARADO=_LOCAL, FECHA_RESERVADO=_LOCAL, FECHA_ENTREGADO=_LOCAL, ORG_LVL_NUMBER=_LONG,
    FECHA_RESERVA=_LOCAL,
    **_texts(
        "REGION_DESP", "CIUDAD_DESP", "COMUNA_DESP", "DIRECCION_DESP", "NOMBRE_DESP", "FONO_DESP",
        "FONO2_DESP", "OBSERVACION", "NOMBRE_CLI", "E_MAIL", "CORREO_CLI", "FONO_CLI", "LATITUD", "LONGITUD",
    ),
    MONTO_DESP=_NUMBER, FECHA_CREA=_LOCAL, FECHA_CONFIRMA=_LOCAL, FECHA_DESPACHO=_LOCAL,
    FECHA_DESPACHO_ORI=_LOCAL, FECHA_DESPACHO2=_LOCAL, FECHA_PROCESO=_LOCAL,
)

MESSAGES = _schema(
    NUM_RESERVA=_TEXT, FONO_CLI=_TEXT, NOMBRE=_TEXT, FECHA_ENVIO=_LOCAL, STATUS=_TEXT, RESPUESTA=_TEXT
)

COORDINATES = _schema(
    **_texts("NUM_RESERVA", "FONO_CLI", "NOMBRE", "LATITUD", "LONGITUD", "FECHA_COORDENADA"),
    FECHA_PROCESO=_LOCAL, ESTADO=_TEXT, INTENTOS=_LONG,
)

ALERTS = _schema(
    **_texts(
        "NUM_RESERVA", "NOMBRE", "FONO_CLI", "REGION_DESP", "CIUDAD_DESP", "COMUNA_DESP",
        "DIRECCION_DESP", "LATITUD", "LONGITUD", "FECHA_COORDENADA",
    ),
    FECHA_PROCESO=_LOCAL, FECHA_ALERTA=_LOCAL,
)

REASONS = _schema(
    **_texts("Reserva", "SKU", "Motivo", "Sub_Motivo", "Responsable"),
    Fecha_Carga=_INSTANT, Fecha_Actualizacion=_INSTANT,
)

REASON_DETAIL = _schema(
    **_texts("NUM_RESERVA", "SKU", "DESCRIPCION"),
    FECHA_INGRESADO=_LOCAL, FECHA_PREPARADO_TIENDA=_LOCAL, FECHA_PACTADA_RESERVA=_DAY,
    **_texts(
        "SERVICIO", "SUB_TIPO_SERVICIO", "CC_DESPACHA", "ON_TIME", "FLAGCUMPLE", "Control_Contabilizado",
        "Validacion_Conta", "Motivo", "Sub_Motivo", "Responsable", "HASH_RESERVA",
    ),
    HIGHWATERMARK_PROPIO=_INSTANT,
)

#: One located message of the chat feed.
FEED_POINT = T.StructType(
    [T.StructField(n, _TEXT, True) for n in ("clientUid", "latitud", "longitud", "fecha")]
)
FEED = T.StructType([T.StructField("extraInfo", T.ArrayType(FEED_POINT), True)])

#: One product of an order document.
PRODUCT = T.StructType(
    [
        T.StructField("sku", _TEXT, True),
        T.StructField("nombre", _TEXT, True),
        T.StructField("cantidad", _NUMBER, True),
        T.StructField("precio", _NUMBER, True),
    ]
)
