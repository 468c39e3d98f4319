"""Format-preserving pseudonyms for personal numbers, dates and addresses, in DataFrame functions alone.

Candidates are found by one pattern.  Each is validated (check digits, ranges,
calendar) and, if it is valid, permuted by a keyed Feistel network within the
set of valid values of its format: separators, length, check digits and ranges
stay right.  A permutation maps equal values to equal pseudonyms and different
values to different ones, so values stay linked across documents, and whoever
holds the key can invert it (``inverse=True``).

Two kinds of network serve: over pairs of integers in Z_a x Z_b, where the
halves are added to alternately modulo a and modulo b, for formats whose valid
values are a product of two ranges; and over strings of one alphabet, where
the characters of the halves are added to alternately.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10

# Length of an IBAN by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban_of(length: int, countries: str) -> str:
    """Compact or in groups of four."""
    groups, rest = divmod(length - 4, 4)
    return "(?:" + "|".join(countries.split()) + f")[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{groups}}}" + (f" ?[A-Z0-9]{{{rest}}}" if rest else "") + "(?![A-Za-z0-9])"


# The formats looked for.  Where one could end at several places, the likelier end stands first, by
# its shape alone, so that the pseudonym is found again.  No group repeats without a bound, and no part of an address that could hold one.
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_ISO = r"[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9])"
_DIGIT = rf"(?:[ .-]?\(?(?!{_ISO})[0-9]\)?)"
_PHONE_END = r"(?![0-9]|-[0-9])"
_CARD_END = r"(?![0-9A-Za-z]|[.-][0-9])"
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,126}[A-Za-z]{2,63}(?![A-Za-z0-9-])",
    "ip": rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])",
    "iso_date": r"(?<![0-9-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9]|-[0-9])",
    "date": r"(?<![0-9./])[0-9]{2}([./])[0-9]{2}\1[0-9]{4}(?![0-9]|[./][0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
    "iban": r"(?<![A-Za-z0-9])(?=[A-Z]{2}[0-9]{2})(?:" + "|".join(_iban_of(n, c) for n, c in IBAN_LENGTHS.items())
            + r"|[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))",
    "nanp": r"(?<![0-9A-Za-z+])(?:1[ .-]?)?(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[ .-])[2-9][0-9]{2}[ .-][0-9]{4}(?![0-9])",
    "phone": r"(?<![0-9A-Za-z+])\+(?:1(?:" + "|".join(f"{_DIGIT}{{{n}}}{_PHONE_END}" for n in ("10", "11,14", "7,9")) + f")|[2-9]{_DIGIT}{{7,14}}{_PHONE_END})",
    "card": r"(?<![0-9A-Za-z.+-])(?:[0-9]{13,19}" + _CARD_END + "|[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4}(?:[ -][0-9]{3}" + _CARD_END + ")?" + _CARD_END
            + "|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5}" + _CARD_END + "|(?=[0-9]{3}|[0-9](?:[ -][0-9]){12})[0-9](?:[ -]?[0-9]){12,18}" + _CARD_END + ")",
}
#: Four groups of four digits and one of three: sixteen digits and a check number, or nineteen digits.
_NINETEEN = "^[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{3}$"
#: Steps a permutation goes on at most to leave the numbers that it must not give; each is needed one time in ten.
WALK = 16
#: Days that both a year of the 112 from 1920 and their product form share: no century year but 2000 lies among them.
FIRST_DAY, LAST_DAY = "1920-01-01", "2031-12-31"
#: The days of those years are 84 x 487, those of a leap year 6 x 61, of another 5 x 73.
DAYS, LEAP, PLAIN = (84, 487), (6, 61), (5, 73)

_DATE = PATTERNS["date"].replace(r"([./])", "[./]").replace(r"\1", "[./]")
CANDIDATE = "|".join([PATTERNS["email"], PATTERNS["iban"], PATTERNS["ip"], PATTERNS["iso_date"], _DATE, PATTERNS["ssn"], PATTERNS["nanp"], PATTERNS["phone"], PATTERNS["card"]])


def let(*values: Column, use: Callable[..., Column]) -> Column:
    """``use(*values)`` with every value computed once."""
    if not values:
        return use()
    return F.element_at(F.transform(F.array(values[0]), lambda v: let(*values[1:], use=lambda *rest: use(v, *rest))), 1)


def _is(match: Column, kind: str) -> Column:
    return F.regexp_like(match, F.lit("^(?:" + PATTERNS[kind] + ")$"))


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _number(key: str, *parts: Column) -> Column:
    """A keyed pseudo-random number below 2^60."""
    inner = F.sha2(F.concat_ws("|", F.lit(key), *[p.cast("string") for p in parts]), 256)
    return F.conv(F.substring(F.sha2(F.concat(F.lit(key), inner), 256), 1, 15), 16, 10).cast("long")


def _steps(inverse: bool) -> Column:
    return F.array(*[F.lit(r) for r in (reversed(range(ROUNDS)) if inverse else range(ROUNDS))])


def permute_pair(a: Column, b: Column, size_a: Column, size_b: Column, key: str, tweak: str, inverse: bool = False) -> Column:
    """struct(a, b): the pair of integers permuted within 0..size_a-1 and 0..size_b-1."""
    sign = -1 if inverse else 1

    def step(x: Column, r: Column) -> Column:
        even = F.pmod(x["a"] + sign * F.pmod(_number(key, F.lit(tweak), r, x["b"]), size_a), size_a)
        odd = F.pmod(x["b"] + sign * F.pmod(_number(key, F.lit(tweak), r, x["a"]), size_b), size_b)
        return F.when(r % 2 == 0, F.struct(even.alias("a"), x["b"].alias("b"))).otherwise(F.struct(x["a"].alias("a"), odd.alias("b")))

    return F.aggregate(_steps(inverse), F.struct(a.cast("long").alias("a"), b.cast("long").alias("b")), step)


def permute_string(s: Column, alphabet: str, key: str, tweak: Column, inverse: bool = False) -> Column:
    """The string of ``alphabet`` permuted among those of its length."""
    sign, radix = -1 if inverse else 1, len(alphabet)

    def work(s: Column, tweak: Column) -> Column:
        def added(x: Column, other: Column, r: Column) -> Column:
            def one(c: Column, j: Column) -> Column:
                shift = F.pmod(_number(key, tweak, F.length(s), r, j, other), F.lit(radix))
                return F.substring(F.lit(alphabet), (F.pmod(F.instr(F.lit(alphabet), c) - 1 + sign * shift, F.lit(radix)) + 1).cast("int"), F.lit(1))

            return F.array_join(F.transform(F.filter(F.split(x, ""), lambda c: c != ""), one), "")

        def step(x: Column, r: Column) -> Column:
            return F.when(r % 2 == 0, F.struct(added(x["a"], x["b"], r).alias("a"), x["b"].alias("b"))).otherwise(
                F.struct(x["a"].alias("a"), added(x["b"], x["a"], r).alias("b")))

        half = (F.length(s) / 2).cast("int")
        start = F.struct(F.substring(s, F.lit(1), half).alias("a"), F.substring(s, half + 1, F.length(s)).alias("b"))
        return F.aggregate(_steps(inverse), start, step, lambda x: F.concat(x["a"], x["b"]))

    return let(s, tweak, use=work)


def refill(layout: Column, members: str, new: Column) -> Column:
    """``layout`` with its characters of the class ``members`` replaced, in turn, by those of ``new``."""
    def work(layout: Column, new: Column) -> Column:
        def one(c: Column, i: Column) -> Column:
            upto = F.length(F.regexp_replace(F.substring(layout, F.lit(1), (i + 1).cast("int")), f"[^{members}]", ""))
            return F.when(F.regexp_like(c, F.lit(f"^[{members}]$")), F.substring(new, upto, F.lit(1))).otherwise(c)

        return F.array_join(F.transform(F.split(layout, ""), one), "")

    return let(layout, new, use=work)


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of a string of digits whose last one counts once."""
    def one(c: Column, i: Column) -> Column:
        d = c.cast("int")
        return F.when(i % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))

    return F.aggregate(F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""), one), F.lit(0), lambda x, y: x + y)


def mod_97(text: Column) -> Column:
    """Remainder by 97 of letters and digits read as an IBAN's number."""
    def step(x: Column, c: Column) -> Column:
        return F.when(F.regexp_like(c, F.lit("^[0-9]$")), (x * 10 + c.cast("int")) % 97).otherwise((x * 100 + F.ascii(c) - 55) % 97)

    return F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), F.lit(0), step)


def _card(m: Column, key: str, inverse: bool) -> Column:
    """The first sixteen of nineteen grouped digits if they are valid, else all digits, which then become none whose first sixteen are."""
    def renewed(d: Column) -> Column:
        body = F.concat(F.substring(d, 1, 1), permute_string(F.substring(d, F.lit(2), F.length(d) - 2), "0123456789", key, F.lit("card"), inverse))
        return let(body, use=lambda x: F.concat(x, F.pmod(10 - luhn_sum(F.concat(x, F.lit("0"))) % 10, F.lit(10)).cast("string")))

    def work(d: Column, grouped: Column) -> Column:
        def head_valid(x: Column) -> Column:
            return grouped & (luhn_sum(F.substring(x, 1, 16)) % 10 == 0)

        part = let(F.when(head_valid(d), F.substring(d, 1, 16)).otherwise(d), use=lambda d: F.when(luhn_sum(d) % 10 == 0, renewed(d)))
        steps = F.sequence(F.lit(1), F.when(grouped, F.lit(WALK)).otherwise(F.lit(1)))
        # Sixteen digits and a number behind them need no further step; nineteen go on while their first sixteen are valid.
        new = let(part, use=lambda x: F.when(F.length(x) < F.length(d), F.concat(x, F.substring(d, 17, 3))).otherwise(
            F.when(grouped, F.aggregate(steps, x, lambda y, _: F.when(luhn_sum(F.substring(y, 1, 16)) % 10 == 0, renewed(y)).otherwise(y))).otherwise(x)))
        return let(new, use=lambda x: F.when(x.isNotNull(), refill(m, "0-9", x)).otherwise(m))

    return let(_digits(m), F.regexp_like(m, F.lit(_NINETEEN)), use=work)


def _iban(m: Column, key: str, inverse: bool) -> Column:
    def work(flat: Column, bank: Column) -> Column:
        country = F.substring(flat, 1, 2)
        digits = permute_string(_digits(bank), "0123456789", key, F.concat(F.lit("iban"), country, F.regexp_replace(bank, "[0-9]", "0")), inverse)
        new = let(refill(bank, "0-9", digits), use=lambda x: F.concat(
            country, F.lpad((98 - mod_97(F.concat(x, country, F.lit("00")))).cast("string"), 2, "0"), x))
        return F.when(mod_97(F.concat(bank, F.substring(flat, 1, 4))) == 1, refill(m, "A-Z0-9", new)).otherwise(m)

    return let(F.regexp_replace(m, " ", ""), F.substring(F.regexp_replace(m, " ", ""), 5, 99), use=work)


def _ssn(m: Column, key: str, inverse: bool) -> Column:
    """Areas 001 to 899 without 666, groups 01 to 99, serials 0001 to 9999."""
    area, group, serial = (F.substring(m, a, n).cast("long") for a, n in ((1, 3), (5, 2), (8, 4)))
    place = F.when(area > 666, area - 2).otherwise(area - 1)
    new = permute_pair(place, (group - 1) * 9999 + serial - 1, F.lit(898), F.lit(99 * 9999), key, "ssn", inverse)
    text = let(new, use=lambda x: F.format_string(
        "%03d-%02d-%04d", F.when(x["a"] >= 665, x["a"] + 2).otherwise(x["a"] + 1), F.floor(x["b"] / 9999) + 1, x["b"] % 9999 + 1))
    return F.when((area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0), text).otherwise(m)


def _ip(m: Column, key: str, inverse: bool) -> Column:
    o = [F.element_at(F.split(m, r"\."), i).cast("long") for i in (1, 2, 3, 4)]
    new = permute_pair(o[0] * 256 + o[1], o[2] * 256 + o[3], F.lit(65536), F.lit(65536), key, "ip", inverse)
    return let(new, use=lambda x: F.concat_ws(".", *[v.cast("string") for half in (x["a"], x["b"]) for v in (F.floor(half / 256), half % 256)]))


def _nanp(m: Column, key: str, inverse: bool) -> Column:
    """Area and exchange codes begin with 2 to 9; a leading country code stays."""
    def work(d: Column) -> Column:
        ten = F.substring(d, F.length(d) - 9, F.lit(10))
        new = permute_pair(F.substring(ten, 1, 3).cast("long") - 200, F.substring(ten, 4, 7).cast("long") - 2000000, F.lit(800), F.lit(8000000), key, "nanp", inverse)
        head = F.substring(d, F.lit(1), F.length(d) - 10)
        return refill(m, "0-9", let(new, use=lambda x: F.concat(head, (x["a"] + 200).cast("string"), (x["b"] + 2000000).cast("string"))))

    return let(_digits(m), use=work)


def _phone(m: Column, key: str, inverse: bool) -> Column:
    """The first digit stays; 8 to 15 digits are a number."""
    def work(d: Column) -> Column:
        new = F.concat(F.substring(d, 1, 1), permute_string(F.substring(d, F.lit(2), F.length(d)), "0123456789", key, F.lit("phone"), inverse))
        return F.when(F.length(d).between(8, 15), refill(m, "0-9", new)).otherwise(m)

    return let(_digits(m), use=work)


def _email(m: Column, key: str, inverse: bool) -> Column:
    """Letters and digits before the top-level domain are permuted; letters keep their case."""
    def work(front: Column, tail: Column) -> Column:
        lower = F.lower(front)
        shape = F.concat(F.lit("email"), F.lower(tail), F.regexp_replace(F.regexp_replace(front, "[A-Za-z]", "a"), "[0-9]", "0"))
        letters = permute_string(F.regexp_replace(lower, "[^a-z]", ""), "abcdefghijklmnopqrstuvwxyz", key, shape, inverse)
        digits = permute_string(_digits(front), "0123456789", key, shape, inverse)

        def cased(new: Column) -> Column:
            def one(c: Column, i: Column) -> Column:
                x = F.substring(new, (i + 1).cast("int"), F.lit(1))
                return F.when(F.regexp_like(c, F.lit("^[A-Z]$")), F.upper(x)).otherwise(x)

            return F.array_join(F.transform(F.split(front, ""), one), "")

        return F.concat(let(refill(refill(lower, "a-z", letters), "0-9", digits), use=cased), tail)

    tail = r"\.[A-Za-z]+$"
    return let(F.regexp_replace(m, tail, ""), F.regexp_extract(m, tail, 0), use=work)


def _day(day: Column, key: str, inverse: bool) -> Column:
    """A date permuted among those of 1920 to 2031; another one within its year."""
    first = F.to_date(F.lit(FIRST_DAY))

    def work(day: Column) -> Column:
        n = F.date_diff(day, first)
        near = permute_pair(F.floor(n / DAYS[1]), n % DAYS[1], F.lit(DAYS[0]), F.lit(DAYS[1]), key, "date", inverse)
        near = let(near, use=lambda x: F.date_add(first, (x["a"] * DAYS[1] + x["b"]).cast("int")))
        k, leap = F.dayofyear(day) - 1, F.dayofyear(F.make_date(F.year(day), F.lit(12), F.lit(31))) == 366
        a, b = (F.when(leap, x).otherwise(y) for x, y in zip(LEAP, PLAIN))
        far = permute_pair(F.floor(k / b), k % b, a, b, key, "day", inverse)
        far = let(far, use=lambda x: F.date_add(F.make_date(F.year(day), F.lit(1), F.lit(1)), (x["a"] * b + x["b"]).cast("int")))
        return F.when(day.between(first, F.to_date(F.lit(LAST_DAY))), near).when(day.isNotNull(), far)

    return let(day, use=work)


def _iso_date(m: Column, key: str, inverse: bool) -> Column:
    return F.coalesce(F.date_format(_day(F.try_to_date(m, "yyyy-MM-dd"), key, inverse), "yyyy-MM-dd"), m)


def _date(m: Column, key: str, inverse: bool) -> Column:
    """Day first if that is a date, else month first."""
    mark = F.substring(m, 3, 1)
    flat = F.regexp_replace(m, "[./]", "-")
    day = F.date_format(_day(F.try_to_date(flat, "dd-MM-yyyy"), key, inverse), "dd-MM-yyyy")
    month = F.date_format(_day(F.try_to_date(flat, "MM-dd-yyyy"), key, inverse), "MM-dd-yyyy")
    return F.coalesce(F.replace(F.coalesce(day, month), F.lit("-"), mark), m)


KINDS: dict[str, Callable[[Column, str, bool], Column]] = {
    "email": _email, "ip": _ip, "iso_date": _iso_date, "date": _date, "ssn": _ssn, "iban": _iban, "nanp": _nanp, "card": _card, "phone": _phone}


def pseudonym(match: Column, key: str, inverse: bool = False) -> Column:
    """The pseudonym of one candidate; a candidate that is not valid stays."""
    out = None
    for kind, f in KINDS.items():
        out = F.when(_is(match, kind), f(match, key, inverse)) if out is None else out.when(_is(match, kind), f(match, key, inverse))
    return out.otherwise(match)


def pseudonymised(text: Column, key: str, inverse: bool = False) -> Column:
    """struct(text, n): the text with every valid value replaced, and the number of values replaced."""
    between = F.split(text, CANDIDATE, -1)

    def joined(found: Column, new: Column) -> Column:
        body = F.zip_with(F.slice(between, F.lit(1), F.size(found)), new, lambda a, b: F.concat(a, b))
        changed = F.size(F.filter(F.zip_with(found, new, lambda a, b: a != b), lambda x: x))
        return F.struct(F.concat(F.array_join(body, ""), F.element_at(between, -1)).alias("text"), changed.cast("long").alias("n"))

    found = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))
    replaced = let(found, use=lambda m: let(F.transform(m, lambda x: pseudonym(x, key, inverse)), use=lambda new: joined(m, new)))
    # Every format has a digit or an @; a text without either is left at once, and so is one without a candidate.
    return F.when(F.regexp_like(text, F.lit("[0-9@]")) & F.regexp_like(text, F.lit(CANDIDATE)), replaced).otherwise(
        F.struct(text.alias("text"), F.lit(0).cast("long").alias("n")))


def pseudonymise(df: DataFrame, key: str, text_col: str = "text", *, inverse: bool = False, count_col: str | None = None) -> DataFrame:
    """``df`` with the personal values of ``text_col`` replaced by pseudonyms, all else unchanged.

    Recognised, if valid: payment cards (Luhn), IBANs (mod 97), US social
    security numbers (ranges), North American and international phone numbers,
    IPv4 addresses, calendar dates (yyyy-MM-dd, dd.MM.yyyy, dd/MM/yyyy,
    MM/dd/yyyy) and e-mail addresses (a local part of up to 64 characters, a
    domain of up to 127 labels of 63).  ``count_col`` names a column to add
    with the number of values replaced (it takes the place of one of that name).  ``inverse`` restores the values.

    A null text stays null (count 0), an empty one empty.  Texts of any length
    are worked whole, row by row, without a shuffle.  Repeated rows come out
    equal.  Other columns are not looked at, whatever their names.  A
    permutation may leave a value as it is; for the smallest sets of values
    (e-mails of one letter) that is likelier.
    """
    done = "pseudonymised"
    while done in df.columns:
        done += "_"
    out = df.withColumn(done, pseudonymised(F.col(text_col).cast("string"), key, inverse))
    columns = [F.col(f"{done}.text").alias(c) if c == text_col else F.col(f"`{c}`") for c in df.columns if c != count_col]
    return out.select(*columns, *([F.col(f"{done}.n").alias(count_col)] if count_col else []))
