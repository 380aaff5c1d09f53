"""Format-preserving pseudonyms by keyed Feistel permutations (operator 10), native SQL functions only.

Numbers and dates that pass their own validation are permuted within their format:

* payment cards (Luhn): length, separators and first digit stay, the check digit is made anew;
* telephone numbers (+1 plan) and social security numbers: valid area and exchange ranges stay valid;
* IPv4 addresses: any valid address to a valid address;
* dates from 1800 to 2199: a valid date in the same notation;
* mail addresses: letters and digits of the local part, place by place; the domain stays.

A value is split into two residues (a mod A, b mod B) and each round adds a keyed
hash of one to the other, which is a permutation of the format's whole domain.
Equal values of a kind thus get equal pseudonyms in all documents, however they
are separated, and different values different ones.

Documents need no shuffle: text between the finds and the finds themselves come
from one pattern (``split`` and ``regexp_extract_all``), the finds are transformed
in place.  Texts without a digit or an at sign are passed through untouched.
A number is left alone only within a longer one of its own kind (``1.2.3.4.5``) or a
word (``v1.2.3.4``); commas, times, prefix lengths and intervals beside it don't hide it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiflow.llm.common import free_name

ROUNDS = 10
#: The notations, in order of preference where two could match.
DATE = r"[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}"
IPV4 = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?:\.(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])){3}"
SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"
PHONE = (
    r"(?:\+?1[ .-]?)?\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|\+1[ .-]?[0-9]{3}[ .-]?[0-9]{3}[ .-]?[0-9]{4}"
    r"|(?:1[ .-])?[2-9][0-9]{2}[ .-][2-9][0-9]{2}[ .-][0-9]{4}"
)
CARD = r"[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}|[0-9]{13,19}"
MAIL = r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,8}\.[A-Za-z]{2,24}"  # bounded, so long texts need no deep stack
KINDS = {"date": DATE, "ipv4": IPV4, "ssn": SSN, "phone": PHONE, "card": CARD}
_CARD_HERE = CARD.replace("([ -])", "(?:[ -])").replace(r"\1", "[ -]")


def _alone(pattern: str, marks: str, after: str = "[A-Za-z0-9]") -> str:
    """``pattern`` where no digit goes on beyond one of ``marks``, the separators within its own kind:
    other neighbours (a comma, a slash before a prefix length, a time) don't make it part of a longer number."""
    return rf"(?<![0-9][{marks}])(?:{pattern})(?!{after})(?![{marks}][0-9])"


_ISO, _SLASHED, _DOTTED = DATE.split("|")
_TIME_FOLLOWS = r"(?!T[0-9]|Z(?![A-Za-z0-9]))[A-Za-z0-9]"  # what may not follow: letters and digits but a time or zone
PATTERN = rf"(?<![A-Za-z0-9._%+-]){MAIL}|(?<![A-Za-z0-9])(?=[0-9+(])(?:" + "|".join(
    [_alone(_ISO, "-", _TIME_FOLLOWS), _alone(_SLASHED, "/"), _alone(_DOTTED, "."), _alone(IPV4, "."), _alone(SSN, "-"), _alone(PHONE, ".-"), _alone(_CARD_HERE, ".-")]
) + ")"

_INT = "bigint"


def _lit(n: int) -> Column:
    return F.lit(n).cast(_INT)


def permute(kind: str, a: Column, b: Column, size_a: Column, size_b: Column, key: str) -> Column:
    """Struct (a, b) after all rounds; a < size_a, b < size_b before and after."""

    def added(r: Column, x: Column) -> Column:
        said = F.sha2(F.concat_ws(":", F.lit(key), F.lit(kind), r.cast("string"), x.cast("string")), 256)
        return F.conv(F.substring(said, 1, 15), 16, 10).cast(_INT)

    def turn(s: Column, r: Column) -> Column:
        even = F.struct(F.pmod(s["a"] + added(r, s["b"]) % size_a, size_a).alias("a"), s["b"].alias("b"))
        odd = F.struct(s["a"].alias("a"), F.pmod(s["b"] + added(r, s["a"]) % size_b, size_b).alias("b"))
        return F.when(r % 2 == 0, even).otherwise(odd)

    start = F.struct(a.cast(_INT).alias("a"), b.cast(_INT).alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _number(s: Column) -> Column:
    return F.coalesce(s.try_cast(_INT), _lit(0))


def _put(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced, one after the other, by ``digits``."""
    places = F.sequence(F.lit(1), F.length(shape))

    def at(i: Column) -> Column:
        here = F.substring(shape, i, F.lit(1))
        return F.when(here.rlike("[0-9]"), F.substring(digits, F.length(_digits(F.substring(shape, F.lit(1), i))), F.lit(1))).otherwise(here)

    return F.array_join(F.transform(places, at), "")


def _luhn(payload: Column) -> Column:
    """The check digit (string) of the digits before it."""
    n = F.length(payload)

    def add(total: Column, i: Column) -> Column:
        d = _number(F.substring(payload, i, F.lit(1)))
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return total + F.when((n - i) % 2 == 0, twice).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(1), n), _lit(0), add)
    return F.pmod(10 - total % 10, _lit(10)).cast("string")


def _pad(x: Column, width: Column | int) -> Column:
    return F.lpad(x.cast("string"), width, "0")


def _card(m: Column, key: str) -> Column:
    def with_digits(d: Column) -> Column:
        n = F.length(d) - 2  # between the first digit and the check digit
        half = F.floor(n / 2).cast("int")
        rest = (n - half).cast("int")
        size_a, size_b = F.pow(F.lit(10.0), half).cast(_INT), F.pow(F.lit(10.0), rest).cast(_INT)
        a, b = _number(F.substring(d, F.lit(2), half)), _number(F.substring(d, half + 2, rest))

        def joined(s: Column) -> Column:
            payload = F.concat(F.substring(d, 1, 1), _pad(s["a"], half), _pad(s["b"], rest))
            return _put(m, F.concat(payload, _luhn(payload)))

        valid = _luhn(F.substring(d, F.lit(1), F.length(d) - 1)) == F.substring(d, F.length(d), F.lit(1))
        return F.when(valid, _once(permute("card", a, b, size_a, size_b, key), joined)).otherwise(m)

    return _once(_digits(m), with_digits)


def _phone(m: Column, key: str) -> Column:
    """Numbers of valid area and exchange (both from 200 on) stay valid, the others stay others."""

    def with_digits(d: Column) -> Column:
        ten = F.substring(d, F.length(d) - 9, F.lit(10))
        area, exchange, line = (_number(F.substring(ten, *x)) for x in ((1, 3), (4, 3), (7, 4)))

        def written(area: Column, rest: Column) -> Column:
            return _put(m, F.concat(F.substring(d, F.lit(1), F.length(d) - 10), _pad(area, 3), _pad(rest, 7)))

        good = permute("phone", area - 200, (exchange - 200) * 10000 + line, _lit(800), _lit(8_000_000), key)
        # the others in a row: areas below 200 (2e9 numbers), then exchanges below 200 of other areas (1.6e9): 60000 squared
        index = F.when(area < 200, area * 10_000_000 + exchange * 10000 + line).otherwise(_lit(2_000_000_000) + (area - 200) * 2_000_000 + exchange * 10000 + line)
        other = permute("phone2", F.floor(index / 60000), index % 60000, _lit(60000), _lit(60000), key)

        def other_written(s: Column) -> Column:
            i = s["a"] * 60000 + s["b"]
            late = i - 2_000_000_000
            return F.when(i < 2_000_000_000, written(F.floor(i / 10_000_000), i % 10_000_000)).otherwise(written(F.floor(late / 2_000_000) + 200, late % 2_000_000))

        return F.when(
            (area >= 200) & (exchange >= 200), _once(good, lambda s: written(s["a"] + 200, s["b"] + 2_000_000))
        ).otherwise(_once(other, other_written))

    return _once(_digits(m), with_digits)


def _ssn(m: Column, key: str) -> Column:
    area, group, serial = (_number(F.substring(m, *x)) for x in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    a = area - F.when(area > 666, 2).otherwise(1)
    b = (group - 1) * 9999 + serial - 1

    def joined(s: Column) -> Column:
        new_area = s["a"] + F.when(s["a"] >= 665, 2).otherwise(1)
        return F.concat_ws("-", _pad(new_area, 3), _pad(F.floor(s["b"] / 9999) + 1, 2), _pad(s["b"] % 9999 + 1, 4))

    return F.when(valid, _once(permute("ssn", a, b, _lit(898), _lit(99 * 9999), key), joined)).otherwise(m)


def _ipv4(m: Column, key: str) -> Column:
    octet = [_number(F.get(F.split(m, r"\."), F.lit(i))) for i in range(4)]
    a, b = octet[0] * 256 + octet[1], octet[2] * 256 + octet[3]

    def joined(s: Column) -> Column:
        return F.concat_ws(".", *[x.cast("string") for v in ("a", "b") for x in (F.floor(s[v] / 256), s[v] % 256)])

    return _once(permute("ipv4", a, b, _lit(65536), _lit(65536), key), joined)


def _date(m: Column, key: str) -> Column:
    """Year-month-day; month/day/year, or day/month/year where only that is a date; day.month.year."""
    orders = (r"^[0-9]{4}-", "yyyy-MM-dd"), ("/", "M/d/yyyy"), ("/", "d/M/yyyy"), (r"\.", "d.M.yyyy")
    epoch = F.lit("1800-01-01").cast("date")
    # two-digit fields where the value's first two have them
    wide = m.rlike(r"^[0-9]{2}[/.][0-9]{2}[/.]|^[0-9]{4}-")

    def as_written(fmt: str) -> Callable[[Column], Column]:
        padded = fmt if fmt.startswith("y") else fmt.replace("M", "MM").replace("d", "dd")

        def joined(s: Column) -> Column:
            new = F.date_add(epoch, (s["b"] * 27 + s["a"]).cast("int"))
            return F.when(wide, F.date_format(new, padded)).otherwise(F.date_format(new, fmt))

        return joined

    out = m
    for mark, fmt in reversed(orders):
        index = F.datediff(F.to_date(F.try_to_timestamp(m, F.lit(fmt))), epoch)
        moved = _once(permute("date", F.pmod(index, F.lit(27)), F.floor(index / 27), _lit(27), _lit(5411), key), as_written(fmt))
        out = F.when(m.rlike(mark) & index.between(0, 146096), moved).otherwise(out)
    return out


def _mail(m: Column, key: str) -> Column:
    """Letters and digits of each half of the local part move by amounts that the other half gives."""

    def moved(chars: Column, other: Column, r: Column) -> Column:
        said = F.sha2(F.concat_ws(":", F.lit(key), F.lit("mail"), r.cast("string"), F.array_join(other, "")), 256)

        def place(c: Column, i: Column) -> Column:
            by = F.conv(F.substring(said, (i % 32) * 2 + 1, F.lit(2)), 16, 10).cast("int")
            ranges = (("[a-z]", 97, 26), ("[A-Z]", 65, 26), ("[0-9]", 48, 10))
            out = c
            for pattern, low, size in ranges:
                out = F.when(c.rlike(pattern), F.char(F.lit(low) + (F.ascii(c) - low + by) % size)).otherwise(out)
            return out

        return F.transform(chars, place)

    def with_local(local: Column) -> Column:
        chars = F.transform(F.sequence(F.lit(1), F.length(local)), lambda i: F.substring(local, i, F.lit(1)))
        half = F.floor(F.length(local) / 2).cast("int")

        def turn(s: Column, r: Column) -> Column:
            even = F.struct(moved(s["a"], s["b"], r).alias("a"), s["b"].alias("b"))
            odd = F.struct(s["a"].alias("a"), moved(s["b"], s["a"], r).alias("b"))
            return F.when(r % 2 == 0, even).otherwise(odd)

        start = F.struct(F.slice(chars, F.lit(1), half).alias("a"), F.slice(chars, half + 1, F.length(local)).alias("b"))
        done = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)
        return _once(done, lambda s: F.concat(F.array_join(F.concat(s["a"], s["b"]), ""), F.lit("@"), F.substring_index(m, "@", -1)))

    return _once(F.substring_index(m, "@", 1), with_local)


def pseudonym(m: Column, key: str) -> Column:
    """The pseudonym of one find of ``PATTERN``; a find that fails validation stays as it is."""
    return (
        F.when(m.contains("@"), _mail(m, key))
        .when(m.rlike(f"^(?:{DATE})$"), _date(m, key))
        .when(m.rlike(f"^{IPV4}$"), _ipv4(m, key))
        .when(m.rlike(f"^{SSN}$"), _ssn(m, key))
        .when(m.rlike(f"^(?:{PHONE})$"), _phone(m, key))
        .otherwise(_card(m, key))
    )


def pseudonymise(df: DataFrame, key: str, text_col: str = "text", count_col: str = "n_replaced") -> DataFrame:
    """``df`` with the text's finds replaced by pseudonyms, and the number of finds that changed.

    A null text stays null and an empty one empty (0 replaced); repeated rows repeat;
    all other columns stay, ``count_col`` replaces a column of that name.  Whole texts are
    searched, however long; an empty table stays empty.
    """
    text = F.col(text_col)
    found, gaps, new = (free_name(df, n) for n in ("_found", "_gaps", "_new"))
    names = [c for c in df.columns if c.lower() not in (count_col.lower(), text_col.lower())]
    some = text.rlike("[0-9@]")
    split = (
        df.withColumn(found, F.when(some, F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))))
        .withColumn(gaps, F.when(F.size(found) > 0, F.split(text, PATTERN, -1)))
        .withColumn(new, F.when(F.size(found) > 0, F.transform(found, lambda m: pseudonym(m, key))))
    )
    filled = F.zip_with(new, F.slice(gaps, F.lit(2), F.size(gaps)), lambda r, g: F.concat(r, g))
    joined = F.when(F.size(found) > 0, F.concat(F.get(gaps, F.lit(0)), F.array_join(filled, ""))).otherwise(text)
    changed = F.size(F.filter(F.zip_with(found, new, lambda a, b: a != b), lambda x: x))
    return split.select(*[F.col(c) for c in names], joined.alias(text_col), F.when(F.size(found) > 0, changed).otherwise(0).cast("long").alias(count_col))
