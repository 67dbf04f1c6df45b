"""Labels, code lists and word lists that results depend on.

Everything here is data. The values must stay exactly as they are for results to
match; operators take them as default arguments, so a caller can pass others.
"""

# Ordered month labels, keyed by month number.
MONTH_LABELS = {
    1: "1. Enero", 2: "2. Febrero", 3: "3. Marzo", 4: "4. Abril",
    5: "5. Mayo", 6: "6. Junio", 7: "7. Julio", 8: "8. Agosto",
    9: "9. Septiembre", 10: "10. Octubre", 11: "11. Noviembre", 12: "12. Diciembre",
}

# Ordered weekday labels, keyed by day of week with Sunday = 1.
WEEKDAY_LABELS = {
    1: "7. Domingo", 2: "1. Lunes", 3: "2. Martes", 4: "3. Miércoles",
    5: "4. Jueves", 6: "5. Viernes", 7: "6. Sábado",
}

# Self-service till codes, as document prefixes of three characters.
SELF_SERVICE_TILL_CODES = (
    "847", "838", "844", "598", "755", "784", "788", "831", "873", "958", "830", "888", "976",
    "977", "865", "912", "845", "712", "426", "854", "925", "568", "231", "883", "849", "840",
)

# Till classes.
TILL_MOBILE = "MPOS"
TILL_SELF_SERVICE = "Caja SCO"
TILL_ASSISTED = "Caja Asistida"

# Sales channels.
CHANNEL_STORE = "TIENDA"
CHANNEL_RETURNS = "DEVOLUCIONES"
CHANNEL_BUSINESS = "VENTA EMPRESA"
CHANNEL_REMOTE = "VAD"
CHANNEL_UNKNOWN = "NO IDENTIFICADO"

# Store-type codes that mean remote sale, and survey codes that do.
REMOTE_STORE_TYPES = ("2", "3", "5", "11", "12", "15")
REMOTE_SURVEY_TYPES = ("6", "9")

# Fixed value: first month of the current channel rule.
CHANNEL_RULE_START = "2024-06-01"

# Recommendation classes, and code -> label maps of the survey.
NPS_PROMOTER = "Promotor"
NPS_NEUTRAL = "Neutro"
NPS_DETRACTOR = "Detractor"
NPS_UNCLASSIFIED = "Sin Clasificación"
PRODUCT_USE = {1: "Uso personal", 2: "Uso laboral"}
ROPO = {1: "Si", 2: "No"}
PRICE_PERCEPTION = {
    "1": "De precio bajo",
    "2": "Del mismo precio",
    "3": "De alto precio",
    "4": "De muy alto precio",
}

# Hour buckets outside the opening hours.
HOUR_UNKNOWN = "no identificado"
HOUR_OPEN, HOUR_CLOSE = 7, 22

# Survey filter.
SURVEY_COUNTRY = "4"
SURVEY_STATUS = "COMPLETED"
SURVEY_YEARS = (2024, 2025, 2026)
INSTALLATION_YEAR_FROM = 2025

# Booking states.
BOOKING_STATES = {
    "cancelled": "Cancelado",
    "done": "Completado",
    "waiting_scheduling_mechanism": "Esperando mecanismo de programación",
    "created": "Creado",
    "waiting_customer_to_set_date": "Esperando que el cliente defina la fecha",
    "arrived_to_destination": "Llegó al destino",
    "accepted": "Aceptado",
    "left_destination": "Salió del destino",
    "waiting_assignment_mechanism": "Esperando mecanismo de asignación",
    "waiting_provider_to_propose_date": "Esperando que el proveedor proponga fecha",
    "on_my_way": "En camino",
    "searching": "Buscando",
    "waiting_customer_to_accept_proposed_date": "Esperando que el cliente acepte la fecha propuesta",
}

# Payment states.
PAYMENT_STATES = {"pending": "Pendiente", "approved": "Aprobado"}

# Budget states.
BUDGET_STATES = {
    "provider_submitted": "Enviado por el Proveedor",
    "created": "Cargado por el Proveedor",
    "waiting_customer_approval": "Esperando aprobación del Cliente",
    "waiting_admin_approval": "Esperando aprobación del Administrador",
    "in_progress": "En proceso de creación",
    "customer_approved": "Aprobado por el Cliente",
    "customer_rejected": "Rechazado por el Cliente",
}

# Budget flags, booking roles and project states.
BUDGETED, NOT_BUDGETED = "Presupuestado", "No Presupuestado"
ROLE_BUDGET, ROLE_EXECUTION, ROLE_OTHER = "PRESUPUESTO", "EJECUCION", "OTRO"
PROJECT_EXECUTED = "EJECUTADO"
PROJECT_PENDING = "PENDIENTE DE EJECUTAR"
PROJECT_NO_BUDGET = "SIN PRESUPUESTO"
PRIMARY, SECONDARY = "PRINCIPAL", "SECUNDARIO"

# Document-reference quality.
DOC_OK, DOC_NO_NUMBER, DOC_EMPTY = "OK", "SIN_NUMERO_BF", "VACIO"

# Line event codes and express extract parameters.
EVENT_BLOCKED, EVENT_RESERVED, EVENT_EN_ROUTE, EVENT_PREPARED = 300, 9, 112, 110
EXPRESS_ORIGIN = 10
EXPRESS_SLOTS = ("E1", "E2", "E3", "E4", "E5", "E6")

# Location-tracker extract parameters.
TRACKER_ORIGINS = (97,)
TRACKER_DISTRICTS = (
    "VILLA EL SALVADOR", "SAN ANTONIO", "PUCUSANA", "SAN BARTOLO", "CHILCA", "PUNTA NEGRA",
    "LURIN", "ASIA", "PUNTA HERMOSA", "CERRO AZUL", "SANTA MARIA DEL MAR", "MALA", "VENTANILLA",
    "PUENTE PIEDRA", "CHACLACAYO", "LURIGANCHO", "ANCON", "MI PERU", "SANTA ROSA", "PACHACAMAC",
    "CIENEGUILLA", "CARABAYLLO", "SANTA ANITA", "LOS OLIVOS", "COMAS", "SAN JUAN DE LURIGANCHO",
    "SAN JUAN DE MIRAFLORES", "INDEPENDENCIA", "SAN MARTIN DE PORRES",
)
MISSING_COORD_TEXTS = ("", "0", "0.0")

# Phone rules.
PHONE_NULL_WORDS = ("", "null", "none", "nan", "n/a", "-")
PHONE_COUNTRY = "51"
PHONE_BLACKLIST = ("51999999999", "51888888888", "51777777777")
DEFAULT_CLIENT_NAME = "CLIENTE"

# Capture states, send states and accepted status codes.
STATE_FOUND, STATE_NO_ANSWER = "ENCONTRADA", "SIN_RESPUESTA"
SEND_OK, SEND_NO_TRACKING, SEND_ERROR = "ENVIADO", "SIN_TRACKING", "ERROR"
SEND_GEOCODE_ERROR = "ERROR_GOOGLE"
ACCEPTED_STATUS = ("200", "201")
DIGEST_TITLE = "NUEVAS ÓRDENES"

# Dispatch document.
DISPATCH_VEHICLE = "BIKE"
DISPATCH_PAYMENT = "ONLINE"
GEOCODE_COUNTRY = "PERU"

# Service types of the pending-reason audit.
SERVICE_TYPES = {
    "DADc": ("DADc", "DADc VEV"),
    "DADPis": ("DADt PIS", "DADt VE PIS", "RT PIS"),
    "RT": ("RT STS", "RT STS VEV", "DADt STS", "DADt STS VEV"),
}
COUNTED = "Contabilizado"
LATE = "0"
REASON_COLUMNS = ("SKU", "Reserva", "Motivo", "Sub_Motivo", "Responsable")
REASON_KEYS = ("SKU", "Reserva", "Motivo")
RESYNC_DAYS = 4
