"""Names, URLs and SIP identifiers as Column expressions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def distinct_chars(s: Column) -> Column:
    """Different characters; letters count by their case."""
    return F.when(F.length(s) > 0, F.size(F.array_distinct(F.split(s, "")))).otherwise(0)


def digit_count(s: Column) -> Column:
    return F.length(F.regexp_replace(s, "[^0-9]", ""))


def host_name(host: Column) -> Column:
    """Lower case, without one leading `www.` and a closing dot."""
    return F.regexp_replace(F.regexp_replace(F.lower(host), r"^www\.", ""), r"\.$", "")


def url_key(host: Column, path: Column) -> Column:
    """Host and path as one lower-case key: one leading `www.` and one closing slash go."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.concat(F.coalesce(host, F.lit("")), F.coalesce(path, F.lit("")))), r"^www\.", ""), "/$", "")


def parent_domain(name: Column) -> Column:
    """What follows the first label; the name itself where it has one label only."""
    return F.when(F.instr(name, ".") > 0, F.regexp_replace(name, r"^[^.]*\.", "")).otherwise(name)


def sip_identity(uri: Column) -> Column:
    """A SIP address without its scheme, parameters and headers."""
    return F.regexp_replace(F.regexp_replace(uri, "^sips?:", ""), "[;?].*$", "")


def sip_user(uri: Column, longest: int = 50) -> Column:
    return F.substring(F.substring_index(sip_identity(uri), "@", 1), 1, longest)


def sip_host(uri: Column) -> Column:
    return F.when(F.instr(uri, "@") > 0, F.substring_index(sip_identity(uri), "@", -1))


def is_dialable(callee: Column) -> Column:
    return F.coalesce(callee.rlike(r"^[0-9+*#:-]+(@|$)"), F.lit(False))


def query_values(url: Column) -> Column:
    """Different values of a URL's query, decoded, sorted."""
    query = F.coalesce(F.try_parse_url(url, F.lit("QUERY")), F.lit(""))
    values = F.transform(F.filter(F.split(query, "&"), lambda x: F.instr(x, "=") > 0), lambda x: F.url_decode(F.regexp_replace(x, "^[^=]*=", "")))
    return F.array_sort(F.array_distinct(values))


def query_names(url: Column) -> Column:
    query = F.coalesce(F.try_parse_url(url, F.lit("QUERY")), F.lit(""))
    return F.array_sort(F.array_distinct(F.transform(F.filter(F.split(query, "&"), lambda x: F.instr(x, "=") > 0), lambda x: F.substring_index(x, "=", 1))))


@F.pandas_udf(T.StringType())
def idna(name: pd.Series) -> pd.Series:
    """A domain name in its ASCII form; null where it has none."""

    def ascii_form(x: str | None) -> str | None:
        try:
            return x.encode("idna").decode()
        except UnicodeError:
            return None

    return name.map(ascii_form, na_action="ignore")
