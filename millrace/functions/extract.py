"""Codes, routes, origins, periods and extension dates in commercial texts."""

from __future__ import annotations

import re
from datetime import date

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import WHOLE_NAMES

TOUR_CODE = r"[A-Za-z0-9_]+FF[0-9]+"
CODE_RANGE = r"[A-Za-z0-9_]+FF[0-9]+(?:/[0-9]+)+"
_DATED = r"(?:\d{1,2}\s?(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\s?\d{2,4}|\d{4}-\d{1,2}-\d{1,2}|\d{4}\s?年\s?\d{1,2}\s?月\s?\d{1,2}\s?日|\d{1,2}/\d{1,2}/\d{2,4})"
_DATE = re.compile(_DATED, re.I)
# fixed values: what a previous version is called, what a deadline stands after, and what ends the part that tells of it
_PREVIOUS = re.compile(r"previous\s+vers(?:ion)?\b|(?:old|former)\s+version\b|previously\s+filed\b|上一版本|宽限期", re.I)
_DEADLINE = re.compile(rf"(?:up\s?to|until|till|before|latest|\bby|至|到|为|期|:)\s*:?\s*({_DATED})", re.I)
_UPDATED = re.compile("最后更新")
_CJK_GAP = re.compile(r"(?<=[一-鿿])\s+(?=[一-鿿])")
_PERIOD = re.compile(rf"\b(sales|ticketing|tkt|iss|issue|issued|dep|departure|travel|trvl)\b[\s_:]*(?:on|from)?[\s_]*((?:until|till|upto|up to)?)[\s_]*({_DATED})(?:\s*(?:-|–|to|until|till)?\s*({_DATED}))?", re.I)
_MONTHS = {m: i + 1 for i, m in enumerate("jan feb mar apr may jun jul aug sep oct nov dec".split())}
WINDOW_WORDS = 30
# fixed values: places by name with their codes
_PLACES = {"USA": "US", "US": "US", "MEX": "MX", "MEXICO": "MX", "CANADA": "CA", "CHINA": "CN", "JAPAN": "JP", "INDIA": "IN", "LATIN AMERICA": "LATIN AMERICA", "ASIA": "ASIA"}
_PLACE = r"(?:LATIN AMERICA|[A-Z]{2,})"
_PLACE_LIST = rf"{_PLACE}(?:\s*(?:/|,|\bAND\b|\bOR\b)\s*{_PLACE})*"
_NOT_PLACES = frozenset("ON THE FOR FROM TO CX KA CODE SHARE FLIGHT UPFRONT DISCOUNT COMMISSION TRAFFIC ONLY OTHER THAN".split())


def tour_codes(docs: DataFrame, key: str, words: str) -> DataFrame:
    """(key, code, n, adhoc) of the tour codes in a word list.

    A code may be one word, two (a part that ends in digits, then FF and digits) or
    three (that part, FF, digits).  It is ad hoc if ADHOC stands within the five
    words up to it, or if it ends in 6.  A range such as ``X4601FF801/701`` gives
    its stem with every tail.
    """
    over = Window.partitionBy(key).orderBy("pos")
    rows = docs.select(key, F.posexplode(words).alias("pos", "word"))
    rows = rows.withColumn("one", F.lag("word", 1, "").over(over)).withColumn("two", F.lag("word", 2, "").over(over))
    near = F.max(F.upper("word").contains("ADHOC").cast("int")).over(over.rowsBetween(-4, 0)) == 1
    ranges = F.regexp_extract("word", CODE_RANGE, 0)
    parts = F.split(ranges, "/")
    stem = F.regexp_replace(F.get(parts, F.lit(0)), "[0-9]{3}$", "")
    spread = F.concat(F.slice(parts, 1, 1), F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda t: F.concat(stem, t)))
    plain = F.regexp_extract("word", TOUR_CODE, 0)
    head = r"[A-Za-z0-9]\w+\d+$"
    two = F.when(F.col("word").rlike(r"^FF\d+") & F.col("one").rlike(head), F.array(F.concat("one", F.regexp_extract("word", r"^FF\d+", 0))))
    three = F.when(F.col("word").rlike(r"^\d+") & (F.col("one") == "FF") & F.col("two").rlike(head), F.array(F.concat("two", F.lit("FF"), F.regexp_extract("word", r"^\d+", 0))))
    codes = F.when(ranges != "", spread).when(plain != "", F.array(plain)).otherwise(F.coalesce(two, three))
    found = rows.withColumn("near", near).select(key, "near", F.explode(codes).alias("code"))
    return found.groupBy(key, "code").agg(F.count("*").alias("n"), F.bool_or(F.col("near") | F.col("code").endswith("6")).alias("adhoc"))


def route_ends(route: Column) -> Column:
    """struct(from_location, to_location): the places on both sides of a route, null for none.

    Sides are parted by TO or a dash; without either all places are on both sides.
    ``ALL ...`` stands for itself.
    """
    text = F.upper(F.trim(F.regexp_replace(F.coalesce(route, F.lit("")), r"(?i)\*|\bonly\b", "")))
    text = F.regexp_replace(text, r"\bAISA\b", "ASIA")
    text = F.regexp_replace(text, r"(^|\s)(?!(?:" + "|".join(WHOLE_NAMES) + r")\b)(TO|OR|AND)([A-Z]{3,})", "$1$2 $3")
    text = F.regexp_replace(F.regexp_replace(text, r"\b(LATIN) (AMERICA)\b", "$1_$2"), r"\b(HONG) (KONG)\b", "$1_$2")
    text = F.regexp_replace(text, r"\b(NORTH|SOUTH) (ASIA)\b", "$1_$2")
    text = F.regexp_replace(F.trim(text), r"^(\w+) (ASIA)$", "$1 - $2")
    text = F.regexp_replace(text, r"^(\w+) (\w+) AND \1 (\w+)$", "$1 - $2 AND $3")
    parting = r"^(.*?)(?:\s*[-–—]\s*|(?:^|\s+)TO\b\s*)(.*)$"

    def places(side: Column) -> Column:
        names = F.filter(F.split(side, r"[,/\s]+"), lambda x: ~x.isin("", "OR", "AND", "FROM"))
        return F.when(F.size(names) > 0, F.transform(names, lambda x: F.translate(x, "_", " ")))

    parted = text.rlike(parting)
    one = F.when(parted, places(F.regexp_extract(text, parting, 1))).otherwise(places(text))
    two = F.when(parted, places(F.regexp_extract(text, parting, 2))).otherwise(places(text))
    itself = text.startswith("ALL ")
    return F.struct(F.when(itself, F.array(text)).otherwise(one).alias("from_location"), F.when(itself, F.array(text)).otherwise(two).alias("to_location"))


def _day(text: str) -> date | None:
    low = text.lower().strip()
    try:
        if m := re.fullmatch(r"(\d{1,2})\s?([a-z]{3})[a-z]*\s?(\d{2,4})", low):
            year = int(m[3])
            return date(year + 2000 if year < 100 else year, _MONTHS[m[2]], int(m[1]))
        if m := re.fullmatch(r"(\d{4})-(\d{1,2})-(\d{1,2})", low):
            return date(int(m[1]), int(m[2]), int(m[3]))
        if m := re.fullmatch(r"(\d{4})\s?年\s?(\d{1,2})\s?月\s?(\d{1,2})\s?日", low):
            return date(int(m[1]), int(m[2]), int(m[3]))
        if m := re.fullmatch(r"(\d{1,2})/(\d{1,2})/(\d{2,4})", low):
            one, two, year = int(m[1]), int(m[2]), int(m[3])
            year = year + 2000 if year < 100 else year
            return date(year, two, one) if two <= 12 else date(year, one, two)
    except ValueError:
        return None
    return None


def extension_date(text: str | None) -> date | None:
    """Until when a previous version holds: the least deadline in the 30 words after it is named, else in the 30 before.

    What is said of the last update of the sheet doesn't count.
    """
    plain = _CJK_GAP.sub("", text or "").replace("：", ":")
    found: list[date] = []
    for match in _PREVIOUS.finditer(plain):
        # what the mention itself ends in may stand right before the date
        after = plain[match.end() - 1 : match.end()] + " " + " ".join(plain[match.end() :].split(None, WINDOW_WORDS)[:WINDOW_WORDS])
        before = " ".join(plain[: match.start()].rsplit(None, WINDOW_WORDS)[-WINDOW_WORDS:])
        for side in (_UPDATED.split(after)[0], before):
            if days := [day for m in _DEADLINE.finditer(side) if (day := _day(m[1]))]:
                found.append(min(days))
                break
    return min(found, default=None)


def periods(text: str | None) -> dict[str, list[tuple[date, date]]]:
    """Sales and travel periods; an open start is 2016-01-01, an open end 9999-12-31."""
    found: dict[str, list[tuple[date, date]]] = {"sales": [], "travel": []}
    for word, until, one, two in _PERIOD.findall((text or "").replace("_", " ")):
        kind = "travel" if word.lower() in ("dep", "departure", "travel", "trvl") else "sales"
        first, second = _day(one), _day(two) if two else None
        if first is None:
            continue
        pair = (date(2016, 1, 1), first) if until else (first, second or date(9999, 12, 31))
        if pair not in found[kind]:
            found[kind].append(pair)
    return found


def origins(text: str | None) -> list[str]:
    """Where travel has to start: +place, or -place after OTHER THAN."""
    upper = re.sub(r"\s+", " ", (text or "").upper())
    lists = [("-", m[1]) for m in re.finditer(rf"\bORIGINATING OTHER THAN ({_PLACE_LIST})", upper)]
    lists += [("+", m[1]) for m in re.finditer(rf"\bORIGINATING (?:FROM|IN) ({_PLACE_LIST})", upper)]
    lists += [("+", m[1]) for m in re.finditer(rf"\bFOR ({_PLACE_LIST}) ORIGINATING\b", upper)]
    found: list[str] = []
    for sign, places in lists:
        for place in re.split(r"\s*(?:/|,|\bAND\b|\bOR\b)\s*", places):
            place = place.strip()
            if place and place not in _NOT_PLACES and (place in _PLACES or len(place) == 3):
                found.append(sign + _PLACES.get(place, place))
    return list(dict.fromkeys(found))


def flights(text: str | None, carriers: tuple[str, ...] = ("CX", "KA", "AA")) -> list[str]:
    """+flight, or -flight after EXCLUDING; bare numbers take the only carrier."""
    upper = (text or "").upper()
    found = []
    for m in re.finditer(r"(EXCLUDING|EXCEPT|EXCL)?\s*(?:FLIGHTS?\s+)?\b([A-Z]{2})\s?(\d{2,4})((?:\s*/\s*(?:[A-Z]{2}\s?)?\d{2,4})*)", upper):
        if m[2] not in carriers:
            continue
        sign = "-" if m[1] else "+"
        found.append(sign + m[2] + m[3])
        found += [sign + (more[0] or m[2]) + more[1] for more in re.findall(r"/\s*([A-Z]{2})?\s?(\d{2,4})", m[4])]
    return list(dict.fromkeys(found))


def extension_date_of(text: Column) -> Column:
    @F.pandas_udf("date")
    def of(texts: pd.Series) -> pd.Series:
        return texts.map(extension_date)

    return of(text)


def origins_of(text: Column) -> Column:
    @F.pandas_udf("array<string>")
    def of(texts: pd.Series) -> pd.Series:
        return texts.map(origins)

    return of(text)


def flights_of(text: Column) -> Column:
    @F.pandas_udf("array<string>")
    def of(texts: pd.Series) -> pd.Series:
        return texts.map(flights)

    return of(text)


def periods_of(text: Column, kind: str) -> Column:
    """array<struct<from,to>> of one kind, as ISO dates."""

    @F.pandas_udf("array<struct<`from`:string,`to`:string>>")
    def of(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [{"from": a.isoformat(), "to": b.isoformat()} for a, b in periods(t)[kind]])

    return of(text)


def choose_periods(body: Column, from_name: Column) -> Column:
    """The periods of the body, else of the file name, else one open period."""
    open_period = F.array(F.struct(F.lit("2016-01-01").alias("from"), F.lit("9999-12-31").alias("to")))
    given = lambda c: F.when(F.size(c) > 0, c)
    return F.coalesce(given(body), given(from_name), open_period)


def place_kind(code: Column) -> Column:
    """country, region, code (of a city or an airport) or name of one end of a route."""
    upper = F.upper(code)
    countries = F.array(*[F.lit(k) for k, v in sorted(_PLACES.items()) if len(v) == 2])
    regions = F.array(*[F.lit(k) for k, v in sorted(_PLACES.items()) if len(v) > 2])
    return F.when(F.array_contains(countries, upper), "country").when(F.array_contains(regions, upper), "region").when(upper.rlike("^[A-Z]{3}$"), "code").when(upper != "", "name")


def place_kinds(places: DataFrame, reference: DataFrame) -> DataFrame:
    """(place, kind) by a table of (code, city, country): city, airport, country or region; by its form if the table lacks it.

    A code that is its own city's is a city, even where an airport has the same one;
    a country's code or name is a country.
    """
    codes = reference.groupBy(F.col("code").alias("place")).agg(F.max((F.col("code") == F.col("city")).cast("int")).alias("is_city"))
    countries = reference.select(F.col("country").alias("place")).distinct().withColumn("is_country", F.lit(1))
    joined = places.select("place").distinct().join(codes, "place", "left").join(countries, "place", "left")
    kind = F.when(F.col("is_city") == 1, "city").when(F.col("is_city") == 0, "airport").when(F.col("is_country") == 1, "country").otherwise(place_kind(F.col("place")))
    return joined.select("place", kind.alias("kind"))


def unpack_pair(text: Column) -> Column:
    """``VIA CX888/889`` as [+CX888, +CX889]; other texts alone."""
    pair = r"^VIA ([A-Z]{2})(\d+)/(\d+)$"
    both = F.array(F.concat(F.lit("+"), F.regexp_extract(text, pair, 1), F.regexp_extract(text, pair, 2)), F.concat(F.lit("+"), F.regexp_extract(text, pair, 1), F.regexp_extract(text, pair, 3)))
    return F.when(text.rlike(pair), both).otherwise(F.array(text))
