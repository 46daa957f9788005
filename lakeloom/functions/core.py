"""Column functions: everything stays inside Catalyst, no Python UDF."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeloom.functions import constants as C


def _pads(salt: str) -> tuple[str, str]:
    key = salt.encode()
    key = hashlib.sha256(key).digest() if len(key) > 64 else key
    key = key.ljust(64, b"\0")
    return bytes(b ^ 0x36 for b in key).hex(), bytes(b ^ 0x5C for b in key).hex()


def hmac_sha256(value: Column, salt: str, empty_is_null: bool = False) -> Column:
    """Keyed pseudonym: HMAC-SHA256 in hex; null stays null."""
    inner, outer = _pads(salt)
    value = F.when(value != "", value) if empty_is_null else value
    first = F.sha2(F.concat(F.unhex(F.lit(inner)), F.encode(value, "UTF-8")), 256)
    return F.sha2(F.concat(F.unhex(F.lit(outer)), F.unhex(first)), 256)


def surrogate_key(*cols: Column) -> Column:
    return F.sha2(F.concat_ws("||", *[F.coalesce(c.cast("string"), F.lit("_null_")) for c in cols]), 256)


def content_hash(*cols: Column) -> Column:
    return F.sha2(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols]), 256)


def region(country: Column) -> Column:
    out = F.when(country.isNull(), "UNKNOWN")
    for name, members in C.REGIONS.items():
        out = out.when(country.isin(*members), name)
    return out.otherwise("OTHER")


def is_gdpr(country: Column) -> Column:
    return F.coalesce(country.isin(*C.GDPR_COUNTRIES), F.lit(False))


def masked_city(city: Column, country: Column) -> Column:
    return F.when(is_gdpr(country), F.lit("MASKED")).otherwise(city)


def price_band(price: Column, null_band: str = "unknown") -> Column:
    return F.when(price.isNull(), null_band).when(price < 25, "budget").when(price < 100, "mid").when(price < 300, "premium").otherwise("luxury")


def ltv_band(spend: Column) -> Column:
    return F.when(spend >= 1000, "platinum").when(spend >= 300, "gold").when(spend >= 100, "silver").otherwise("bronze")


def order_tier(total: Column, high: float = 200, mid: float = 50) -> Column:
    return F.when(total >= high, "high_value").when(total >= mid, "mid_value").otherwise("low_value")


def churn_segment(score: Column) -> Column:
    return F.when((score >= 0) & (score < 0.2), "stable").when((score >= 0.2) & (score < 0.5), "monitor").when((score >= 0.5) & (score < 0.75), "at_risk").when((score >= 0.75) & (score < 1.01), "high_churn").otherwise("unknown")


def encode_category(value: Column, codes: Sequence[str]) -> Column:
    """Place in the code list, upper and lower case alike; unknown and null get the last code."""
    place = F.array_position(F.array(*[F.lit(c) for c in codes]), F.lower(value))
    return F.when(place > 0, place - 1).otherwise(len(codes) - 1).cast("int")


def parse_tags(tags: Column) -> Column:
    """JSON list of strings to trimmed, lowered tags without blanks; anything else is an empty list."""
    parsed = F.from_json(tags, "array<string>")
    clean = F.filter(F.transform(parsed, lambda t: F.lower(F.trim(t))), lambda t: t != "")
    return F.coalesce(clean, F.array().cast("array<string>"))


def funnel_depth(event_type: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in C.FUNNEL_DEPTH.items() for x in pair])
    return F.coalesce(F.try_element_at(table, event_type), F.lit(0))


def funnel_stage(depth: Column) -> Column:
    return F.element_at(F.array(*[F.lit(s) for s in C.FUNNEL_STAGES]), depth.cast("int") + 1)


def referrer_source(ref: Column) -> Column:
    r = F.lower(ref)
    return (
        F.when(r.contains("google"), "google").when(r.contains("bing"), "bing").when(r.contains("facebook") | r.contains("fb.com"), "facebook")
        .when(r.contains("instagram"), "instagram").when(r.contains("email") | r.contains("newsletter"), "email")
        .when(r.isNull() | (F.trim(r) == ""), "direct").otherwise("referral")
    )


def referrer_medium(ref: Column) -> Column:
    source = referrer_source(ref)
    return F.when(source.isin("google", "bing"), "organic").when(source.isin("email", "direct"), source).otherwise("referral")


def channel_group(source: Column, medium: Column) -> Column:
    search, social = source.isin("google", "bing"), source.isin("facebook", "instagram")
    return (
        F.when(search & (medium == "cpc"), "Paid Search").when(social & (medium == "cpc"), "Paid Social").when(social, "Organic Social").when(medium == "email", "Email")
        .when(source == "direct", "Direct").when(source == "referral", "Referral").when(medium == "organic", "Organic Search").otherwise("Other")
    )


def parse_event_time(text: Column, fallback: Column) -> Column:
    """ISO-8601 with or without fraction or offset, as UTC; the fallback where it doesn't parse."""
    return F.coalesce(F.try_to_timestamp(text), fallback)


def local_hour(ts: Column, zone: Column) -> Column:
    """Hour of a UTC time in an IANA zone; unknown and missing zones count as UTC."""
    known = F.coalesce(zone.rlike(r"^[A-Za-z]+(/[A-Za-z0-9_+\-]+)*$"), F.lit(False))
    return F.when(known, F.hour(F.from_utc_timestamp(ts, F.when(known, zone).otherwise("UTC")))).otherwise(F.hour(ts))
