"""Personal numbers, dates and addresses replaced by pseudonyms of the same format.

A value that is found and validated becomes a number in the domain of its format, and a keyed Feistel network permutes
that domain: the pseudonym is a value of the same format, equal values have equal pseudonyms in every document, and
different values have different ones. Formats and their domains:

* card numbers: 13 to 19 digits, blanks or hyphens between them, with a right check digit; all digits but the last are
  permuted and the check digit is computed anew;
* telephone numbers: area code and seven digits, written with brackets, blanks, dots or hyphens, +1 before or not;
  the ten digits are permuted;
* international telephone numbers: + and an assigned country code, then ten digits for +1 and +7 and 6 to 12 for the
  others, at most one of blank, dot, slash or hyphen between them, brackets allowed; code and a "(0)" behind it stay,
  the other digits are permuted among those of their number. Digits that follow a number after one blank count to it
  if the length allows, unless a date, an address or a number of another format begins there;
* social security numbers: 3-2-4 digits with an area of 001 to 899 but 666 and no part zero;
* IPv4 addresses: four numbers up to 255;
* dates from 1700 to 2099 that exist, as year-month-day (a time may follow after T), month/day/year, month-day-year or
  day.month.year; the days of those 400 years are permuted, so that a day has one pseudonym in all these forms;
* dates as day/month/year or day-month-year that cannot be read month first; the days from the 13th of a month on are
  permuted among themselves, so that a pseudonym cannot be read month first either;
* e-mail addresses: the letters a to z and the digits before the @ are permuted, each among strings of their length;
  a letter of another script becomes one of a to z, drawn by a keyed digest of the whole part before the @ and its place.

Everything is expressions on a text's own row: nothing moves between tasks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import fresh, position

KEY = "an example key, which everyone knows"  # for the registered query and the tests; a job gives a secret of its own
ROUNDS = 10
CHUNK = 13  # letters of an address that are permuted together: 26 ** 13 fits a long

_EMAIL = (  # possessive, so that no run of such characters is looked at twice
    r"(?<![\p{L}0-9._%+-])(?=[._%+-]*+[\p{L}0-9])[\p{L}0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
)
_DATE = r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}(?:/[0-9]{1,2}/|-[0-9]{1,2}-|\.[0-9]{1,2}\.)[0-9]{4})"
_DATED = (  # a date where it stands: an ISO one may go on with T and a time, a dotted one is no part of a longer number
    r"(?:(?<![/-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}(?![/-])(?=[Tt][0-9]|(?![0-9A-Za-z]))"
    r"|[0-9]{1,2}(?:/[0-9]{1,2}/|-[0-9]{1,2}-)[0-9]{4}(?![/0-9A-Za-z-]))"
    r"|(?<![/.-])[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}(?![/0-9A-Za-z-]|\.[0-9]))"
)
_SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"
_PHONE = r"(?:\+?1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"
_IP = r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}"
_CARD = r"(?:[0-9]{13,19}|[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})"
_COUNTRY = (  # assigned country codes of two and three digits; none begins another
    r"(?:2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|21[1-368]|2[2346][0-9]|25[0-8]|29[01789]|35[0-9]|37[0-9]"
    r"|38[0-35-79]|42[013]|50[0-9]|59[0-9]|67[02-9]|68[0-35-9]|69[0-2]|80[08]|85[02356]|87[08]|88[0-368]|96[0-8]"
    r"|97[0-79]|99[2-68])"
)
_OTHER = rf"(?:{_DATED}|(?:{_SSN}|{_PHONE}|{_CARD})(?![0-9A-Za-z])|{_IP}(?!\.?[0-9A-Za-z]))"
_MORE = rf"(?:(?:[ \xA0](?!{_OTHER})|[./-])?\(?[0-9]\)?)"  # one digit of a number and what stands before it
_CODE = rf"\+(?:[17]|{_COUNTRY})(?:[ \xA0.-]?\(0\))?"
_WORLD = rf"(?:\+[17](?:[ \xA0.-]?\(0\))?{_MORE}{{10}}|\+{_COUNTRY}(?:[ \xA0.-]?\(0\))?{_MORE}{{6,12}})"
NUMBERS = (
    rf"(?=[0-9+(])(?<![0-9A-Za-z])(?:{_DATED}|(?:(?<!-){_SSN}(?!-)|{_PHONE}|{_WORLD}"
    rf"|(?<!\.){_IP}(?!\.[0-9])|{_CARD})(?![0-9A-Za-z]))"
)
ALL = f"(?:{_EMAIL}|{NUMBERS})"
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_FIRST_DAY = "1700-01-01"  # the 400 years from this day have 189 * 773 days, 9 * 9833 of them from a month's 13th on


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def _pick(values: list[int], at: Column) -> Column:
    """The value at a position counted from 0."""
    return F.element_at(F.array(*map(_long, values)), (at + 1).cast("int"))


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it stands in the body."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _characters(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def permuted(number: Column, high: Column, low: Column, kind: str, key: str, tweak: Column | None = None) -> Column:
    """A keyed permutation of the longs below ``high * low``.

    The number is split into a part below ``high`` and one below ``low``; each round adds a keyed hash of one part to
    the other, modulo its size, which can be undone, so that different numbers stay different.
    """
    prefix = [F.lit(key), F.lit(kind)] + ([tweak.cast("string")] if tweak is not None else [])

    def spread(at: Column, part: Column) -> Column:
        digest = F.sha2(F.concat_ws("|", *prefix, at.cast("string"), part.cast("string")), 256)
        return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")

    def step(state: Column, at: Column) -> Column:
        left, right = state["left"], state["right"]
        even = at % 2 == 0
        return F.struct(
            F.when(even, (left + spread(at, right) % high) % high).otherwise(left).alias("left"),
            F.when(even, right).otherwise((right + spread(at, left) % low) % low).alias("right"),
        )

    start = F.struct(_div(number, low).alias("left"), (number % low).alias("right"))
    return F.aggregate(F.array(*map(F.lit, range(ROUNDS))), start, step, lambda s: s["left"] * low + s["right"])


def _permuted_digits(digits: Column, kind: str, key: str) -> Column:
    """A string of 1 to 18 digits permuted among those of its length."""
    size = F.length(digits)
    powers = [10**k for k in range(10)]
    high, low = _pick(powers, _div(size + 1, _long(2))), _pick(powers, _div(size, _long(2)))
    number = permuted(digits.cast("long"), high, low, kind, key, tweak=size)
    return F.lpad(number.cast("string"), size, "0")


def _permuted_letters(letters: Column, tweak: Column, key: str) -> Column:
    """A string of 1 to ``CHUNK`` letters a-z permuted among those of its length."""
    size = F.length(letters)
    powers = [26**k for k in range(CHUNK)]
    number = F.aggregate(
        _characters(letters), _long(0), lambda total, c: total * 26 + F.instr(F.lit(_LETTERS), c).cast("long") - 1
    )
    high, low = _pick(powers, _div(size + 1, _long(2))), _pick(powers, _div(size, _long(2)))

    def spelled(value: Column) -> Column:
        return F.array_join(
            F.transform(
                F.sequence(F.lit(1), size),
                lambda at: F.substring(F.lit(_LETTERS), (_div(value, _pick(powers, size - at)) % 26 + 1).cast("int"), F.lit(1)),
            ),
            "",
        )

    return _let(permuted(number, high, low, "letters", key, F.concat_ws(":", tweak.cast("string"), size.cast("string"))), spelled)


def _chunks(text: Column, size: int, change: Callable[[Column, Column], Column]) -> Column:
    """``change`` of each part of ``size`` characters and its number, joined; empty for an empty text."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)), F.lit(size))
    joined = F.array_join(F.transform(starts, lambda at: change(F.substring(text, at, F.lit(size)), at)), "")
    return F.when(F.length(text) > 0, joined).otherwise(F.lit(""))


def _filled(match: Column, digits: Column) -> Column:
    """``match`` with its digits replaced by ``digits`` in order."""

    def one(c: Column, at: Column) -> Column:
        place = F.length(_digits(F.substring(match, F.lit(1), at + 1)))
        return F.when(c.between("0", "9"), F.substring(digits, place, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(_characters(match), one), "")


def _card(match: Column, key: str) -> Column:
    def renewed(payload: Column) -> Column:
        numbers = F.transform(F.array(*(F.lit(str(k)) for k in range(10))), lambda k: F.concat(payload, k))
        return F.element_at(F.filter(numbers, lambda number: F.call_function("luhn_check", number)), 1)

    digits = _digits(match)
    payload = F.substring(digits, F.lit(1), F.length(digits) - 1)
    new = _let(_permuted_digits(payload, "card", key), lambda p: _let(renewed(p), lambda d: _filled(match, d)))
    return F.when(F.call_function("luhn_check", digits), new)


def _phone(match: Column, key: str) -> Column:
    digits = _digits(match)
    country = F.substring(digits, F.lit(1), F.length(digits) - 10)
    body = F.substring(digits, F.length(digits) - 9, F.lit(10))
    return _let(F.concat(country, _permuted_digits(body, "phone", key)), lambda new: _filled(match, new))


def _world_phone(match: Column, key: str) -> Column:
    code = F.regexp_extract(match, f"^{_CODE}", 0)
    rest = F.substring(match, F.length(code) + 1, F.length(match))
    return F.concat(code, _let(_permuted_digits(_digits(rest), "phone", key), lambda new: _filled(rest, new)))


def _ssn(match: Column, key: str) -> Column:
    area, group, serial = (F.substring(match, at, size).cast("long") for at, size in ((1, 3), (5, 2), (8, 4)))
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    number = ((area - 1 - F.when(area > 666, 1).otherwise(0)) * 99 + group - 1) * 9999 + serial - 1

    def written(new: Column) -> Column:
        place = _div(new, _long(99 * 9999)) + 1
        parts = [
            F.lpad((place + F.when(place >= 666, 1).otherwise(0)).cast("string"), 3, "0"),
            F.lpad((_div(new, _long(9999)) % 99 + 1).cast("string"), 2, "0"),
            F.lpad((new % 9999 + 1).cast("string"), 4, "0"),
        ]
        return F.concat_ws("-", *parts)

    return F.when(valid, _let(permuted(number, _long(898), _long(99 * 9999), "ssn", key), written))


def _ip(match: Column, key: str) -> Column:
    parts = [F.element_at(F.split(match, r"\."), k).cast("long") for k in range(1, 5)]
    valid = (parts[0] <= 255) & (parts[1] <= 255) & (parts[2] <= 255) & (parts[3] <= 255)
    number = ((parts[0] * 256 + parts[1]) * 256 + parts[2]) * 256 + parts[3]

    def written(new: Column) -> Column:
        return F.concat_ws(".", *((_div(new, _long(256**k)) % 256).cast("string") for k in (3, 2, 1, 0)))

    return F.when(valid, _let(permuted(number, _long(65536), _long(65536), "ip", key), written))


def _late_days(months: Column) -> Column:
    """Days from a 13th on in so many months from ``_FIRST_DAY``."""
    first = F.lit(_FIRST_DAY).cast("date")
    return (F.datediff(F.add_months(first, months.cast("int")), first) - months * 12).cast("long")


def _late_day(new: Column) -> Column:
    """The day that is preceded by ``new`` days from a 13th on."""
    about = _div(new * 4800, _long(9 * 9833))  # the month, or one beside it
    near = F.filter(F.transform(F.array(*map(_long, (1, 0, -1))), lambda k: about + k), lambda m: (m >= 0) & (_late_days(m) <= new))
    first = F.lit(_FIRST_DAY).cast("date")
    return _let(
        F.element_at(near, 1), lambda m: F.date_add(F.add_months(first, m.cast("int")), (new - _late_days(m) + 12).cast("int"))
    )


def _date(match: Column, key: str) -> Column:
    parts = F.split(match, "[./-]")
    iso, dotted = F.length(parts[0]) == 4, match.contains(".")
    month_first = ~iso & ~dotted & (parts[0].cast("int") <= 12)  # a date that can be read both ways is read month first
    year, month, day = (
        F.when(iso, parts[a]).when(month_first, parts[b]).otherwise(parts[c]).cast("int")
        for a, b, c in ((0, 2, 2), (1, 0, 1), (2, 1, 0))
    )
    leap = ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)
    last = F.when(month == 2, F.when(leap, 29).otherwise(28)).when(month.isin(4, 6, 9, 11), 30).otherwise(31)
    valid = year.between(1700, 2099) & month.between(1, 12) & (day >= 1) & (day <= last)
    first = F.lit(_FIRST_DAY).cast("date")
    number = F.datediff(F.make_date(year, month, day), first).cast("long")
    mark = F.when(dotted, ".").when(match.contains("/"), "/").otherwise("-")

    def written(new: Column) -> Column:
        text = new.cast("string")
        month, day = F.substring(text, 6, 2), F.substring(text, 9, 2)
        short = F.length(match) < 10
        month, day = (F.when(short, x.cast("int").cast("string")).otherwise(x) for x in (month, day))
        front = F.when(month_first, F.concat(month, mark, day)).otherwise(F.concat(day, mark, month))
        return F.when(iso, text).otherwise(F.concat(front, mark, F.substring(text, 1, 4)))

    def any_day(new: Column) -> Column:
        return written(F.date_add(first, new.cast("int")))

    late = number - ((year - 1700) * 12 + month) * 12
    of_all = _let(permuted(number, _long(189), _long(773), "date", key), any_day)
    of_late = _let(permuted(late, _long(9), _long(9833), "late date", key), lambda new: _let(_late_day(new), written))
    return F.when(valid, F.when(iso | dotted | month_first, of_all).otherwise(of_late))


def _drawn(local: Column, at: Column, key: str) -> Column:
    """A number from 1 to 26, drawn for a place of a text."""
    digest = F.md5(F.concat(F.lit(f"{key}:letter:"), at.cast("string"), F.lit(":"), local))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("long") % 26 + 1).cast("int")


def _email(match: Column, key: str) -> Column:
    def written(local: Column) -> Column:
        letters = _chunks(
            F.lower(F.regexp_replace(local, "[^A-Za-z]", "")), CHUNK, lambda part, at: _permuted_letters(part, at, key)
        )
        digits = _chunks(_digits(local), 18, lambda part, at: _permuted_digits(part, "email", key))

        def one(new: Column) -> Callable[[Column, Column], Column]:
            def character(c: Column, at: Column) -> Column:
                before = F.substring(local, F.lit(1), at + 1)
                letter = F.substring(new["letters"], F.length(F.regexp_replace(before, "[^A-Za-z]", "")), F.lit(1))
                digit = F.substring(new["digits"], F.length(_digits(before)), F.lit(1))
                return (
                    F.when(c.between("a", "z"), letter)
                    .when(c.between("A", "Z"), F.upper(letter))
                    .when(c.between("0", "9"), digit)
                    .when(c.rlike("[0-9._%+-]"), c)
                    .otherwise(F.substring(F.lit(_LETTERS), _drawn(local, at, key), F.lit(1)))
                )

            return character

        both = F.struct(letters.alias("letters"), digits.alias("digits"))
        return _let(both, lambda new: F.array_join(F.transform(_characters(local), one(new)), ""))

    domain = F.substring(match, F.instr(match, "@"), F.length(match))
    return F.concat(_let(F.substring_index(match, "@", 1), written), domain)


def pseudonym(match: Column, key: str) -> Column:
    """``kind, value`` of a match: its pseudonym; both null if it is not valid in its format."""
    kinds = [
        ("email", match.contains("@"), _email),
        ("date", match.rlike(f"^{_DATE}$"), _date),
        ("ssn", match.rlike(f"^{_SSN}$"), _ssn),
        ("phone", match.rlike(f"^{_PHONE}$"), _phone),
        ("phone", match.startswith("+"), _world_phone),
        ("ip", match.rlike(f"^{_IP}$"), _ip),
        ("card", F.lit(True), _card),
    ]
    value, kind = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, fits, change in reversed(kinds):
        value = F.when(fits, change(match, key)).otherwise(value)
        kind = F.when(fits, F.lit(name)).otherwise(kind)
    return _let(value, lambda new: F.struct(F.when(new.isNotNull(), kind).alias("kind"), new.alias("value")))


def pseudonymise(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with every validated value in the whole text replaced by its pseudonym, and ``n_pseudonyms``, their
    number, added (an input column of that name is replaced). ``text`` names its column in any letter case. Equal keys
    link the pseudonyms of several runs; whoever has the key can undo them.

    Values that look like a format but are not valid (a number with a wrong check digit) stay. A null text stays null
    with 0 pseudonyms, an empty one empty. All other columns and all rows, repeated ones too, stay as they are; an
    empty table gives an empty result.
    """
    text = docs.columns[position(docs, text)]
    value = F.col(text).cast("string")
    at, pieces, found, new = (fresh(docs, name) for name in ("split_text", "text_pieces", "text_matches", "new_values"))

    def cut(pattern: str) -> Column:
        return F.struct(
            F.split(value, pattern, -1).alias("pieces"),
            F.regexp_extract_all(value, F.lit(pattern), F.lit(0)).alias("matches"),
        )

    whole = F.struct(F.array(value).alias("pieces"), F.array().cast("array<string>").alias("matches"))
    split = F.when(value.contains("@"), cut(ALL)).when(value.rlike("[0-9]"), cut(NUMBERS)).otherwise(whole)
    rows = docs.withColumn(at, split)
    rows = rows.withColumn(pieces, F.col(at)["pieces"]).withColumn(found, F.col(at)["matches"])
    rows = rows.withColumn(new, F.transform(found, lambda match: pseudonym(match, key)))
    changed = F.zip_with(found, new, lambda old, one: F.coalesce(one["value"], old))
    joined = F.array_join(F.zip_with(pieces, changed, lambda piece, one: F.concat(piece, F.coalesce(one, F.lit("")))), "")
    names = [column for column in docs.columns if column.lower() != "n_pseudonyms"]
    return rows.select(
        *(F.when(value.isNotNull(), joined).alias(name) if name == text else F.col(name) for name in names),
        F.coalesce(F.size(F.filter(new, lambda one: one["value"].isNotNull())), F.lit(0)).cast("long").alias("n_pseudonyms"),
    )
