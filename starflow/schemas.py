"""Declared table layouts of every layer.

A :class:`TableSpec` is the single source of a table's column order, types,
character limits and key. From it come the all-text ingress ``StructType``
(read positionally from CSV), the typed ODS ``StructType`` (varchar limits in
field metadata) and the key/not-null rules the checks enforce.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

VARCHAR_META = "varchar_length"


@dataclass(frozen=True)
class Column:
    name: str
    kind: str  # varchar | numeric | timestamp | int | bigint | date | json | double
    length: int | None = None
    precision: int | None = None
    scale: int | None = None
    nullable: bool = True

    def spark_type(self) -> T.DataType:
        k = self.kind
        if k == "varchar":
            return T.StringType()
        if k == "numeric":
            return T.DecimalType(self.precision or 38, self.scale or 0)
        if k == "timestamp":
            return T.TimestampNTZType()
        if k == "int":
            return T.IntegerType()
        if k == "bigint":
            return T.LongType()
        if k == "date":
            return T.DateType()
        if k == "double":
            return T.DoubleType()
        if k == "json":
            return T.VariantType()
        raise ValueError(f"unknown column kind {k!r} for {self.name}")

    def struct_field(self) -> T.StructField:
        meta = {VARCHAR_META: self.length} if self.kind == "varchar" and self.length else {}
        return T.StructField(self.name, self.spark_type(), self.nullable, meta)


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[Column, ...]
    key: tuple[str, ...] = field(default_factory=tuple)

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def column(self, name: str) -> Column:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(name)

    def ods_schema(self) -> T.StructType:
        return T.StructType([c.struct_field() for c in self.columns])

    def ingress_schema(self) -> T.StructType:
        """All text; only the columns declared NOT NULL stay non-nullable."""
        return T.StructType([T.StructField(c.name, T.StringType(), c.nullable)
                             for c in self.columns])

    @property
    def not_null(self) -> list[str]:
        return [c.name for c in self.columns if not c.nullable]


def spec_from_struct(name: str, schema: T.StructType, key=()) -> TableSpec:
    """Derive a spec from a typed ``StructType`` (varchar limits from metadata)."""
    cols = []
    for f in schema.fields:
        t = f.dataType
        if isinstance(t, T.StringType):
            cols.append(Column(f.name, "varchar", length=f.metadata.get(VARCHAR_META),
                               nullable=f.nullable))
        elif isinstance(t, T.DecimalType):
            cols.append(Column(f.name, "numeric", precision=t.precision, scale=t.scale,
                               nullable=f.nullable))
        elif isinstance(t, (T.TimestampNTZType, T.TimestampType)):
            cols.append(Column(f.name, "timestamp", nullable=f.nullable))
        elif isinstance(t, T.IntegerType):
            cols.append(Column(f.name, "int", nullable=f.nullable))
        elif isinstance(t, T.LongType):
            cols.append(Column(f.name, "bigint", nullable=f.nullable))
        elif isinstance(t, T.DateType):
            cols.append(Column(f.name, "date", nullable=f.nullable))
        elif isinstance(t, T.DoubleType):
            cols.append(Column(f.name, "double", nullable=f.nullable))
        elif isinstance(t, T.VariantType):
            cols.append(Column(f.name, "json", nullable=f.nullable))
        else:
            raise ValueError(f"unsupported type {t} for {f.name}")
    return TableSpec(name, tuple(cols), tuple(key))


def _v(name, n, nullable=True):
    return Column(name, "varchar", length=n, nullable=nullable)


def _n(name, p, s):
    return Column(name, "numeric", precision=p, scale=s)


# ---------------------------------------------------------------------------
# The warehouse layouts (column order, types, limits, keys) that
# results must match.
# ---------------------------------------------------------------------------
COMPANIES_DAILY = TableSpec(
    "companies_daily",
    (
        _v("symbol", 16, nullable=False),
        Column("load_timestamp_utc", "timestamp", nullable=False),
        _n("previous_close", 9, 2),
        _n("open_price", 9, 2),
        _v("bid", 64),
        _v("ask", 64),
        _v("day_range", 64),
        _v("volume", 64),
        _v("avg_volume", 64),
        _v("intraday_market_cap", 32),
        _n("beta", 5, 2),
        _n("pe_ratio", 7, 2),
        _n("eps", 7, 2),
        _v("earnings_date", 128),
        _v("forward_dividend_and_yield", 64),
        _v("ex_dividend_date", 128),
        _n("one_year_target_estimate", 9, 2),
    ),
    key=("symbol", "load_timestamp_utc"),
)

COMPANIES_WEEKLY = TableSpec(
    "companies_weekly",
    (
        _v("symbol", 16, nullable=False),
        Column("load_timestamp_utc", "timestamp", nullable=False),
        _v("company_name", 256),
        _v("company_address", 512),
        _v("company_phone_number", 64),
        _v("company_website", 512),
        _v("company_sector", 128),
        _v("company_industry", 128),
        _v("company_full_time_employees", 64),
        _v("company_description", 65535),
        _v("company_corporate_governance_score", 1024),
    ),
    key=("symbol", "load_timestamp_utc"),
)

TRANSACTIONS = TableSpec(
    "transactions",
    (
        _v("transaction_id", 64, nullable=False),
        Column("customer_id", "int", nullable=False),
        Column("company_id", "int", nullable=False),
        Column("volume_traded", "int", nullable=False),
        Column("transaction_timestamp_utc", "timestamp"),
    ),
    key=("transaction_id",),
)

# Trade record carried in the stream value (field order of the record schema).
TRADE_VALUE_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("customer_id", T.IntegerType()),
    T.StructField("company_id", T.IntegerType()),
    T.StructField("volume_traded", T.IntegerType()),
    T.StructField("transaction_timestamp_utc", T.StringType()),
])
TRADE_KEY_SCHEMA = T.StructType([T.StructField("company_id", T.IntegerType())])

# Seed dimension layouts.
SEED_COMPANIES = T.StructType([
    T.StructField("company_id", T.IntegerType()),
    T.StructField("company_symbol", T.StringType()),
    T.StructField("company_name", T.StringType()),
])
SEED_INDUSTRIES = T.StructType([
    T.StructField("industry_id", T.IntegerType()),
    T.StructField("industry_name", T.StringType()),
])
SEED_SECTORS = T.StructType([
    T.StructField("sector_id", T.IntegerType()),
    T.StructField("sector_name", T.StringType()),
])
SEED_STATES = T.StructType([
    T.StructField("state_id", T.IntegerType()),
    T.StructField("state_symbol", T.StringType()),
    T.StructField("state_name", T.StringType()),
])

SPECS = {s.name: s for s in (COMPANIES_DAILY, COMPANIES_WEEKLY, TRANSACTIONS)}
