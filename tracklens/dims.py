"""The enumerations, lookup rows and defaults every operator shares.

They are contract data, stated as they stand; operators take them as DataFrames or parameters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Formats as (id, label, kind).
FORMATS = [
    ("hardcover", "Hardcover", "physical"),
    ("paperback", "Paperback", "physical"),
    ("kindle", "Kindle", "digital"),
    ("kobo", "Kobo", "digital"),
    ("audiobook", "Audiobook", "digital"),
]
DEFAULT_FORMAT = "paperback"

# Retailers in order.
RETAILERS = ["Amazon", "Kobo", "Bookshop.org", "AbeBooks", "Local shop", "Library", "Already own"]

# Statuses as (ord, id, label); the order drives the cycle.
STATUSES = [(0, "want", "Want"), (1, "reading", "Reading"), (2, "read", "Read")]

# Filter sentinels that mean "off".
ANY = "all"
NO_PRICE_LIMIT = 60
NO_RATING_FLOOR = 0

# Search link templates, {q} is the encoded "title author".
LINK_TEMPLATES = {
    "goodreads": "https://www.goodreads.com/search?q=",
    "amazon": "https://www.amazon.com/s?k=",
    "kobo": "https://www.kobo.com/us/en/search?query=",
    "bookshop": "https://bookshop.org/beta-search?keywords=",
}

# Seed catalogue rows.
SEED_BOOKS = [
    ("b1", "The Brothers Karamazov", "Fyodor Dostoevsky", "hardcover", "Bookshop.org", "24", "4.4", "want",
     "The one the whole comment section is arguing about.", 1),
    ("b2", "Crime and Punishment", "Fyodor Dostoevsky", "paperback", "Amazon", "12", "4.3", "want", "", 2),
    ("b3", "Giovanni's Room", "James Baldwin", "paperback", "Local shop", "14", "4.3", "want", "", 3),
    ("b4", "Ward No. 6", "Anton Chekhov", "kindle", "Amazon", "3", "4.2", "want", "Short — good Oasis reading.", 4),
    ("b5", "Beware of Pity", "Stefan Zweig", "paperback", "AbeBooks", "16", "4.2", "want", "", 5),
]
RAW_BOOK_SCHEMA = (
    "id STRING, title STRING, author STRING, format STRING, retailer STRING, price STRING, "
    "rating STRING, status STRING, note STRING, added BIGINT"
)

# Role codes, their labels, and the words the Markdown tables use for them.
ROLE_LABELS = {"w": "WORK", "f": "READ", "r": "REF"}
ROLE_WORDS = {"Work through": "w", "Read": "f", "Reference": "r"}

# Minutes after midnight that session offsets count from (06:50).
SESSION_BASE_MINUTES = 410

# Names a register point takes, by kind, in order.
POINT_NAMES = {
    "16": ["Status", "Mode", "Fault_Code", "Ramp_Rate"],
    "32": ["P_kW", "Q_kVAr", "V_ll", "Freq_Hz"],
    "bits": ["Alarms", "Trips", "Flags"],
}

# Variation choice as (kind, group, name, with time, without time).
VARIATIONS = [
    ("float", "30 / 32", "Analog input — measured value",
     "variation with flag (and time for events)", "variation without flag"),
    ("int", "30 / 32", "Analog input — integer", "16- or 32-bit with flag", "16- or 32-bit without flag"),
    ("bin", "1 / 2", "Binary input", "with flag; events (group 2) carry the time", "packed / with-status, no time"),
    ("cnt", "20 / 21", "Counter / frozen counter", "with flag; group 21 is the frozen value", "without flag"),
]

# What to send, by whether values must be forced.
SEND_MODES = [(True, "Send the full project"), (False, "Send IEC 61131-3 logic only")]

# Offline-device diagnosis as (node, answer, next node, cause); a leaf has no next node.
DIAGNOSIS = [
    ("start", "none", "noip", None),
    ("start", "flowing", "app", None),
    ("noip", "closed", None, "Firewall."),
    ("noip", "open", None, "Server IP or port mismatch."),
    ("app", "several", None, "Client IP port collision."),
    ("app", "single", None, "Reversed or mismatched DNP addresses."),
]

# Meter protocols as (name, ms, command path?).
PROTOCOLS = [
    ("C37.118 from an SEL-735", 16.7, False),
    ("DNP3 or SEL protocol from an SEL-735", 500.0, False),
    ("Inverter Modbus write cycle", 225.0, True),
]

# Recordable channels as (signal, tag, unit).
CHANNELS = [
    ("P at POI", "POI.PRG.main.P_MW", "MW"),
    ("Q at POI", "POI.PRG.main.Q_MVAr", "MVAr"),
    ("Plant setpoint", "GridConnect.PRG.main.PlantSP", "MW"),
    ("POI frequency", "POI.PRG.main.Freq", "Hz"),
    ("Inverter 03 setpoint", "MPC.PRG.main.InvSP[3]", "kW"),
    ("Clamping state", "MPC.PRG.main.Clamped[3]", "bool"),
]

# Trend window and nominal frequency.
TREND_SECONDS = 90
NOMINAL_HZ = 60.0
PFR_RATING_MW = 50.0


def literal_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A fixed handful of rows as literals inside the plan: no Python RDD, and the optimizer knows the size."""
    fields = StructType.fromDDL(schema).fields
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields, strict=True)]) for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))


def format_dim(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, FORMATS, "format STRING, format_label STRING, kind STRING")


def status_dim(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, STATUSES, "ord INT, status STRING, status_label STRING")


def seed_books(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, SEED_BOOKS, RAW_BOOK_SCHEMA)


def variation_dim(spark: SparkSession) -> DataFrame:
    return literal_rows(
        spark, VARIATIONS, "kind STRING, object_group STRING, name STRING, with_time STRING, without_time STRING"
    )


def send_mode_dim(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, SEND_MODES, "needs_force BOOLEAN, send_mode STRING")


def diagnosis_dim(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, DIAGNOSIS, "node STRING, answer STRING, next STRING, cause STRING")


def channel_dim(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, CHANNELS, "signal STRING, tag STRING, unit STRING")
