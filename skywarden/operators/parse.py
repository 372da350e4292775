"""Raw access records to columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skywarden.functions.codec import cookie_decode
from skywarden.functions.text import NULL_TEXT, key_values, last_wins_map
from skywarden.schema import SEPARATOR

# Slot numbers of a raw record.
RAW_SLOTS = {
    "request_method": 2, "content_type": 3, "request_body": 4, "http_referrer": 5, "remote_addr": 6,
    "http_user_agent": 7, "time_iso8601": 8, "server_addr": 9,
}
COOKIE_SLOT = 10
ACTIVE_SLOT = 11
# Cookie names of session and user.
SESSION_COOKIE = "JSESSIONID"
USER_COOKIE = "userId4logCookie"


def slot(line: Column, index: int) -> Column:
    """One slot of a separated line, empty when the line is too short."""
    return F.coalesce(F.get(F.split(line, SEPARATOR), F.lit(index)), F.lit(""))


def request_url(line: Column) -> Column:
    """Second word of the request line."""
    return F.coalesce(F.get(F.split(slot(line, 1), " "), F.lit(1)), F.lit(""))


def clean_cookies(text: Column) -> Column:
    return F.regexp_replace(text, r"[\x00\s]", "")


def cookie_pairs(text: Column) -> Column:
    """Decoded cookies in order; a value that cannot be decoded leaves its cookie out."""
    decoded = F.transform(
        key_values(text, ";"),
        lambda p: F.struct(p["k"].alias("k"), cookie_decode(p["v"]).alias("v")))
    return F.filter(decoded, lambda p: p["v"].isNotNull())


def cookie_map(text: Column) -> Column:
    return last_wins_map(cookie_pairs(text))


def parse_requests(
    df: DataFrame,
    column: str = "value",
    session_cookie: str = SESSION_COOKIE,
    user_cookie: str = USER_COOKIE,
) -> DataFrame:
    """Replace the raw line by its twelve columns; other columns pass through.

    Lines and cookies are each taken apart once, in a step of their own.
    """
    def part(index: int) -> Column:
        return F.coalesce(F.get("_parts", F.lit(index)), F.lit(""))

    fields = {"request": F.coalesce(F.get(F.split(part(1), " "), F.lit(1)), F.lit(""))}
    fields.update({name: part(i) for name, i in RAW_SLOTS.items()})
    fields["cookies_str"] = clean_cookies(part(COOKIE_SLOT))
    parsed = df.withColumn("_parts", F.split(F.col(column), SEPARATOR)).withColumns(fields)
    parsed = parsed.withColumn("_tokens", key_values(F.col("cookies_str"), ";"))
    return parsed.withColumns({
        "jsessionid": _cookie(F.col("_tokens"), session_cookie),
        "userid": _cookie(F.col("_tokens"), user_cookie),
    }).drop(column, "_parts", "_tokens")


def _cookie(tokens: Column, name: str) -> Column:
    """Decoded value of the last cookie of this name that can be decoded."""
    decoded = F.transform(F.filter(tokens, lambda p: p["k"] == name), lambda p: cookie_decode(p["v"]))
    return F.coalesce(F.try_element_at(F.filter(decoded, lambda v: v.isNotNull()), F.lit(-1)), F.lit(NULL_TEXT))
