"""Table contracts of the mart: input drops, staging extracts, history, facts, report.

Every input is read with an explicit ``StructType``; nothing is inferred, so text ids
such as ``00123`` keep their leading zeros.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the source system's for identical results.
# ---------------------------------------------------------------------------
OPEN_END = "9999-12-31 00:00:00"  # effective_to of an open (current) version
FLAG_LIVE = "N"  # deleted_flg of a live version
FLAG_DELETED = "Y"  # deleted_flg of a deleted version
FIRST_MARK = "1899-12-31 00:00:00"  # seed high-water mark: 1900-01-01 minus one day
TERMINALS_FIRST_MARK = "9999-12-31 00:00:00"  # seed mark of the terminals sheet
OPER_REJECT = "REJECT"
OPER_SUCCESS = "SUCCESS"
PROBE_OPER_TYPES = ("PAYMENT", "WITHDRAW")
EVENT_TYPES = ("1", "2", "3", "4")
CITY_HOP_WINDOW = timedelta(hours=1)  # rule 3: strictly less than
PROBE_WINDOW = timedelta(minutes=20)  # rule 4: first to last, at most
# ---------------------------------------------------------------------------


def ts_lit(text: str) -> Column:
    """A ``timestamp_ntz`` literal (wall clock, no session time zone involved)."""
    return F.lit(text).cast(T.TimestampNTZType())


def date_lit(text: str) -> Column:
    return F.lit(text).cast(T.DateType())


def open_end() -> Column:
    return ts_lit(OPEN_END)


S = T.StringType()
TS = T.TimestampNTZType()
D = T.DateType()

# Daily file drops, in file order (columns bind by position).
TRANSACTIONS_FILE = T.StructType(
    [T.StructField(n, S) for n in
     ("trans_id", "trans_date", "amt", "card_num", "oper_type", "oper_result", "terminal")]
)
TERMINALS_FILE = T.StructType(
    [T.StructField(n, S) for n in ("terminal_id", "terminal_type", "terminal_city", "terminal_address")]
)
BLACKLIST_FILE = T.StructType([T.StructField("entry_dt", S), T.StructField("passport_num", S)])

# Source-system tables (current state with create/update stamps).
SRC_CARDS = T.StructType([
    T.StructField("card_num", S), T.StructField("account", S),
    T.StructField("create_dt", TS), T.StructField("update_dt", TS),
])
SRC_ACCOUNTS = T.StructType([
    T.StructField("account", S), T.StructField("valid_to", D), T.StructField("client", S),
    T.StructField("create_dt", TS), T.StructField("update_dt", TS),
])
SRC_CLIENTS = T.StructType([
    T.StructField("client_id", S), T.StructField("last_name", S), T.StructField("first_name", S),
    T.StructField("patronymic", S), T.StructField("date_of_birth", D),
    T.StructField("passport_num", S), T.StructField("passport_valid_to", D),
    T.StructField("phone", S), T.StructField("create_dt", TS), T.StructField("update_dt", TS),
])

FACT_TRANSACTIONS = T.StructType([
    T.StructField("trans_id", S), T.StructField("trans_date", TS), T.StructField("card_num", S),
    T.StructField("oper_type", S), T.StructField("amt", T.DecimalType(7, 2)),
    T.StructField("oper_result", S), T.StructField("terminal", S),
])
FACT_BLACKLIST = T.StructType([T.StructField("passport_num", S), T.StructField("entry_dt", D)])

REPORT = T.StructType([
    T.StructField("event_dt", TS), T.StructField("passport", S), T.StructField("fio", S),
    T.StructField("phone", S), T.StructField("event_type", S), T.StructField("report_dt", D),
])

META = T.StructType([
    T.StructField("schema_name", S), T.StructField("table_name", S),
    T.StructField("max_update_dt", TS),
])

SCD_COLUMNS = ("effective_from", "effective_to", "deleted_flg")


@dataclass(frozen=True)
class DimSpec:
    """How one type-2 dimension is keyed and versioned.

    ``tracked`` are the attributes whose change opens a new version; ``carried`` are stored
    but never compared (clients keep ``date_of_birth`` that way). ``new_from`` names the stage
    column that starts a first version; a changed version starts at ``update_dt`` (falling
    back to ``create_dt`` when the update stamp is missing).
    """

    name: str
    key: str
    tracked: tuple[str, ...]
    carried: tuple[str, ...] = ()
    new_from: str = "create_dt"
    types: dict = field(default_factory=dict)

    @property
    def attributes(self) -> tuple[str, ...]:
        return self.tracked + self.carried

    @property
    def columns(self) -> tuple[str, ...]:
        """History columns in table order: key, attributes, then the SCD triple."""
        return (self.key,) + self.attributes + SCD_COLUMNS

    def type_name(self, column: str) -> str:
        """SQL type name of an attribute (a string cast is one cheap JVM call)."""
        return self.types.get(column, S).simpleString()

    def history_schema(self) -> T.StructType:
        fields = [T.StructField(self.key, S)]
        fields += [T.StructField(c, self.types.get(c, S)) for c in self.attributes]
        fields += [T.StructField("effective_from", TS), T.StructField("effective_to", TS),
                   T.StructField("deleted_flg", S)]
        return T.StructType(fields)


TERMINALS = DimSpec("terminals", "terminal_id",
                    tracked=("terminal_type", "terminal_city", "terminal_address"),
                    new_from="update_dt")
CARDS = DimSpec("cards", "card_num", tracked=("account_num",))
ACCOUNTS = DimSpec("accounts", "account_num", tracked=("valid_to", "client"),
                   types={"valid_to": D})
CLIENTS = DimSpec("clients", "client_id",
                  tracked=("last_name", "first_name", "patronymic", "passport_num",
                           "passport_valid_to", "phone"),
                  carried=("date_of_birth",),
                  types={"date_of_birth": D, "passport_valid_to": D})
DIMENSIONS = {d.name: d for d in (TERMINALS, CARDS, ACCOUNTS, CLIENTS)}
