"""Raw rows of a channel to the staging contract, as one lazy plan."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Self

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import clean_sku, dmy_to_utc, iso_to_utc, naive_to_utc, parse_int, parse_money
from ..functions.money import beyond_range
from ..operators.lookup import apply_fx, checked, fits, latest_rates, map_status
from ..operators.ordering import dedupe_by_key, drop_incomplete
from .channels import APART, BEYOND, LINE_ORDER, Channel

MONEY = ["unit_price_local", "discount_local", "tax_local", "line_total_local"]
AMOUNTS = [*MONEY, "unit_price_usd", "line_total_usd"]
LINE_KEY = ["platform_order_id", "platform_line_id"]
REQUIRED = ["order_dt_utc", "quantity"]


@dataclass(frozen=True)
class Reference:
    """Reference tables, each checked once for being small enough to broadcast."""

    fx: DataFrame
    latest_fx: DataFrame
    statuses: DataFrame

    @classmethod
    def of(cls, fx: DataFrame, statuses: DataFrame) -> Self:
        rates = fx.select("currency", "rate_date", "rate_to_usd")
        # The latest rates are no more than the rates.
        small = fits(rates)
        return cls(
            fx=F.broadcast(rates) if small else rates,
            latest_fx=F.broadcast(latest_rates(fx)) if small else latest_rates(fx),
            statuses=checked(statuses),
        )


def _instant(df: DataFrame, channel: Channel) -> Column:
    raw = F.col("order_dt_raw")
    if channel.date_parser == "iso":
        return iso_to_utc(raw)
    if channel.date_parser == "naive":
        typed = isinstance(df.schema["order_dt_raw"].dataType, T.TimestampNTZType)
        return naive_to_utc(raw, channel.zone, typed)
    if channel.date_parser == "dmy":
        return dmy_to_utc(raw, channel.zone)
    raise ValueError(f"unknown date parser {channel.date_parser!r}")


def clean(df: DataFrame, channel: Channel) -> DataFrame:
    """Parse SKU, money, quantity and time in one projection."""

    def is_text(name: str) -> bool:
        return isinstance(df.schema[name].dataType, T.StringType)

    def amount(name: str) -> Column:
        if is_text(name):
            return parse_money(F.col(name), channel.decimal_sep)
        return F.col(name).try_cast(schemas.PARSED_AMOUNT)

    def beyond(name: str) -> Column:
        if is_text(name):
            return beyond_range(F.col(name), channel.decimal_sep)
        return F.col(name).isNotNull() & amount(name).isNull()

    def whole(name: str) -> Column:
        if isinstance(df.schema[name].dataType, T.IntegralType):
            return F.col(name).cast("bigint")
        return parse_int(F.col(name))

    cleaned = df.withColumns(
        {
            "source_platform": F.lit(channel.name),
            "platform_sku": clean_sku(F.col("platform_sku")),
            "quantity": whole("quantity"),
            "order_dt_utc": _instant(df, channel),
            **{name: amount(name) for name in MONEY},
            # The first amount that is a number, but none that can be held.
            BEYOND: F.coalesce(*[F.when(beyond(name), F.lit(name)) for name in MONEY]),
        }
    )
    return channel.post_clean(cleaned) if channel.post_clean else cleaned


def newest_lines(df: DataFrame) -> DataFrame:
    """Keep the newest row of a line, then drop what lacks time or quantity.

    In this order a newer broken row hides an older good one. Rows that were dealt by
    order to be numbered are not moved again: all rows of a line are in one task. Only
    of those without an order, which are spread, each task's newest meet once more.
    """
    if APART not in df.columns:
        return drop_incomplete(dedupe_by_key(df, LINE_KEY, LINE_ORDER), REQUIRED)
    newest = dedupe_by_key(df, [*LINE_KEY, APART], LINE_ORDER)
    lost = F.col("platform_order_id").isNull()
    found = newest.where(~lost).unionByName(
        dedupe_by_key(newest.where(lost), LINE_KEY, LINE_ORDER)
    )
    return drop_incomplete(found.drop(APART), REQUIRED)


def refusal(prepared: DataFrame) -> Column:
    """Why a row cannot be stored in staging; null for a row that can."""
    reasons = [
        F.when(F.col(key).isNull(), F.lit(f"{key}: missing")) for key in LINE_KEY
    ] + [
        F.when(
            F.col(name).isNotNull() & F.col(name).try_cast(schemas.AMOUNT).isNull(),
            F.lit(f"{name}: out of range"),
        )
        for name in AMOUNTS
    ]
    reasons.insert(len(LINE_KEY), F.concat(BEYOND, F.lit(": out of range")))
    too_many = F.col("quantity").isNotNull() & F.col("quantity").try_cast("int").isNull()
    return F.coalesce(*reasons, F.when(too_many, F.lit("quantity: out of range")))


def typed(df: DataFrame) -> DataFrame:
    """The staging columns in order and type; what does not fit becomes null."""
    return df.select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schemas.STAGING]
    )


def prepare(
    raw: DataFrame, channel: Channel, reference: Reference, crowded: Sequence[str] = ()
) -> DataFrame:
    """Extract, clean, dedupe and convert the rows of a channel; not yet typed.

    Texts are parsed below the dedupe: a filter on parsed values cannot move below
    it, so that nothing is parsed twice. The lookups come after it, see fewer rows
    and neither add nor drop any. A malformed document yields no lines, or lines
    without key or time; :func:`malformed` names it. ``crowded`` lists orders of
    very many lines, for the channels that number their lines.
    """
    extracted = channel.extract(raw, crowded) if channel.numbers_lines else channel.extract(raw)
    lines = newest_lines(clean(extracted, channel))
    rated = apply_fx(lines, reference.fx, reference.latest_fx, "applied_rate")
    return map_status(rated, reference.statuses)


def judged(
    raw: DataFrame, channel: Channel, reference: Reference, crowded: Sequence[str] = ()
) -> DataFrame:
    """All lines of a channel as staging keeps them, with the ``refusal`` of those that do not fit."""
    prepared = prepare(raw, channel, reference, crowded)
    kept = [f for f in schemas.STAGED_SALES if f.name != "refusal"]
    return prepared.select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in kept],
        refusal(prepared).alias("refusal"),
    )


def normalize(raw: DataFrame, channel: Channel, reference: Reference) -> DataFrame:
    """The staging rows of a channel."""
    return judged(raw, channel, reference).where("refusal IS NULL").select(*schemas.STAGING.names)


def malformed(raw: DataFrame, channel: Channel) -> DataFrame:
    """Raw rows that cannot be extracted, as reject records."""
    reason = F.lit(None).cast("string") if channel.malformed is None else channel.malformed()
    payload = (
        F.col("payload")
        if "payload" in raw.columns
        else F.to_json(F.struct(*raw.columns), {"ignoreNullFields": "false"})
    )
    return raw.select(
        F.lit(channel.name).alias("source_name"),
        F.col("raw_id"),
        reason.alias("reason"),
        payload.alias("payload"),
    ).where(F.col("reason").isNotNull())
