"""Format-preserving pseudonyms by keyed Feistel networks, in Spark's own expressions.

Numbers and dates that pass their check are permuted, under a key, within the set of valid
values of their format: equal values get equal pseudonyms in all documents, different ones
different pseudonyms, however they are punctuated.

==========  ==========================================  =======================================
kind        check                                       what is permuted
==========  ==========================================  =======================================
card        13 to 19 digits, Luhn                       digits after the first; new check digit
iban        ISO 13616 form, mod 97                      account part, in kind; new check digits
phone       North American plan (area, office 2-9)      area, office and line
intl        + and 8 to 15 digits                        digits after the first two
ssn         area 001-899 but 666, group, serial not 0   all of it
ip          four numbers up to 255                      all 32 bits
date        a day of 1800 to 2199                       the day
email       local part and domain                       letters and digits of the local part
==========  ==========================================  =======================================

A value (l, r) of a set of a * b values goes through ``ROUNDS`` double rounds: l becomes
(l + f(r)) mod a and r becomes (r + f(l)) mod b, with f a keyed hash. 400 years have
146,097 = 189 * 773 days, so dates need no second draw; the other sets factor as well.
Strings use two halves and add character by character, within digits, small and capital
letters.

What looks alike but fails its check stays as it is. Cases: a null text stays null with no
finding; repeated rows get the same result each; an empty table gives an empty result; all
columns of the input are kept, whatever their names, and the text is replaced.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 5
KINDS = ("card", "iban", "phone", "intl", "ssn", "ip", "date", "email")

# Characters of an IBAN by country (ISO 13616 registry).
_IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG YE", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC",
    32: "LC", 33: "RU",
}


def _iban_form(length: int, countries: str) -> str:
    """Of the country's length, so that a word or number after it is not drawn in."""
    groups, rest = divmod(length - 4, 4)
    tail = f" ?[A-Z0-9]{{{rest}}}" if rest else ""
    return f"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{groups}}}{tail}"


# Countries without a registered length keep the general form.
_LISTED = " ".join(_IBAN_LENGTHS.values()).replace(" ", "|")
_IBAN_FORMS = [_iban_form(n, countries) for n, countries in _IBAN_LENGTHS.items()]
_IBAN_FORMS.append(f"(?!{_LISTED})[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?")

# What may not be drawn into an international number: dates, social security numbers, cards.
_OTHER = r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}|[0-9]{3}-[0-9]{2}-[0-9]{4}|[0-9]{4} [0-9]{4} [0-9]{4} [0-9]{1,7}|[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])"

# Written out, since Java must see the greatest length of what it looks back for.
_EIGHT_TO_15 = r"(?<=\+[0-9]" + "[ .-]?[0-9]" * 7 + "(?:[ .-]?[0-9])?" * 7 + ")"

# The forms, tried in this order.
_FORMS = (
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9](?:[A-Za-z0-9._%+-]{0,62}[A-Za-z0-9])?@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})+",
    rf"(?<![A-Za-z0-9])(?:{'|'.join(_IBAN_FORMS)})(?![A-Za-z0-9])",
    r"(?<![A-Za-z0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![A-Za-z0-9]|\.[0-9])",
    r"(?<![A-Za-z0-9+])(?:\+?1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![A-Za-z0-9]|-[0-9])",
    # The match ends after 8 to 15 digits, wherever more of them follow.
    rf"\+[0-9]{{1,3}}(?:[ .-]?(?!(?<=[ .-]){_OTHER})[0-9]{{2,4}}){{2,5}}{_EIGHT_TO_15}(?![A-Za-z0-9])",
    r"(?<![A-Za-z0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9]|-[0-9])",
    r"(?<![A-Za-z0-9-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9]|-[0-9])",
    r"(?<![A-Za-z0-9./])[0-9]{1,2}[./][0-9]{1,2}[./][0-9]{4}(?![A-Za-z0-9]|[./][0-9])",
    r"(?<![A-Za-z0-9-])(?:[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5}|[0-9]{13,19})(?![A-Za-z0-9]|-[0-9])",
)
FORM = "|".join(_FORMS)


def _hashed(key: str, kind: str, turn: Column, value: Column) -> Column:
    """A keyed hash of the value as a number below 2**60."""
    text = F.concat_ws("|", F.lit(key), F.lit(kind), turn.cast("string"), value.cast("string"), F.lit(key))
    return F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 15), 16, 10).cast("bigint")


def permuted(key: str, kind: str, left: Column, right: Column, a: int, b: int, back: bool = False) -> Column:
    """A struct (l, r) in a keyed permutation of [0, a) x [0, b)."""

    def turn(pair: Column, i: Column) -> Column:
        first = F.pmod(pair["l"] + F.pmod(_hashed(key, kind, i * 2, pair["r"]), F.lit(a)), F.lit(a))
        second = F.pmod(pair["r"] + F.pmod(_hashed(key, kind, i * 2 + 1, first), F.lit(b)), F.lit(b))
        return F.struct(first.cast("bigint").alias("l"), second.cast("bigint").alias("r"))

    def undo(pair: Column, i: Column) -> Column:
        second = F.pmod(pair["r"] - F.pmod(_hashed(key, kind, i * 2 + 1, pair["l"]), F.lit(b)), F.lit(b))
        first = F.pmod(pair["l"] - F.pmod(_hashed(key, kind, i * 2, second), F.lit(a)), F.lit(a))
        return F.struct(first.cast("bigint").alias("l"), second.cast("bigint").alias("r"))

    turns = F.sequence(F.lit(ROUNDS), F.lit(1)) if back else F.sequence(F.lit(1), F.lit(ROUNDS))
    start = F.struct(left.cast("bigint").alias("l"), right.cast("bigint").alias("r"))
    return F.aggregate(turns, start, undo if back else turn)


def _shifted(text: Column, pad: Column, sign: int) -> Column:
    """``text`` with each letter and digit moved within its kind by the bytes of the hex text ``pad``."""

    def move(char: Column, i: Column) -> Column:
        shift = F.conv(F.substr(pad, F.pmod(i, F.lit(32)) * 2 + 1, F.lit(2)), 16, 10).cast("int") * sign
        code = F.ascii(char)
        within = lambda first, n: F.chr(F.pmod(code - first + shift, F.lit(n)) + first)
        return (
            F.when(char.between("0", "9"), within(48, 10))
            .when(char.between("a", "z"), within(97, 26))
            .when(char.between("A", "Z"), within(65, 26))
            .otherwise(char)
        )

    # Splitting an empty text gives one empty character.
    return F.when(F.length(text) == 0, text).otherwise(F.array_join(F.transform(F.split(text, ""), move), ""))


def permuted_text(key: str, kind: str, text: Column, back: bool = False) -> Column:
    """``text`` under a keyed permutation of the texts of its form."""
    half = F.floor(F.length(text) / 2).cast("int")
    pad = lambda i, other: F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), i.cast("string"), other, F.lit(key)).cast("binary"), 256)

    def turn(pair: Column, i: Column) -> Column:
        first = _shifted(pair["l"], pad(i * 2, pair["r"]), 1)
        return F.struct(first.alias("l"), _shifted(pair["r"], pad(i * 2 + 1, first), 1).alias("r"))

    def undo(pair: Column, i: Column) -> Column:
        second = _shifted(pair["r"], pad(i * 2 + 1, pair["l"]), -1)
        return F.struct(_shifted(pair["l"], pad(i * 2, second), -1).alias("l"), second.alias("r"))

    turns = F.sequence(F.lit(ROUNDS), F.lit(1)) if back else F.sequence(F.lit(1), F.lit(ROUNDS))
    start = F.struct(F.substr(text, F.lit(1), half).alias("l"), F.substr(text, half + 1, F.length(text)).alias("r"))
    return F.aggregate(turns, start, undo if back else turn, lambda pair: F.concat(pair["l"], pair["r"]))


def luhn_sum(digits: Column) -> Column:
    """Luhn's sum over all digits, the last one not doubled."""
    values = F.transform(F.reverse(F.split(digits, "")), lambda c: F.ascii(c) - 48)
    double = lambda d: d * 2 - F.when(d > 4, 9).otherwise(0)
    return F.aggregate(
        F.transform(values, lambda d, i: F.when(i % 2 == 1, double(d)).otherwise(d)), F.lit(0), lambda total, d: total + d
    )


def mod97(text: Column) -> Column:
    """A text of digits and capitals (A = 10 ... Z = 35), read as a number, mod 97."""

    def step(rest: Column, char: Column) -> Column:
        digit = char.between("0", "9")
        value = F.ascii(char) - F.when(digit, 48).otherwise(55)
        return F.pmod(rest * F.when(digit, 10).otherwise(100) + value, F.lit(97)).cast("int")

    return F.aggregate(F.split(text, ""), F.lit(0), step)


def _refilled(form: Column, chars: Column, kept: str = "[0-9]") -> Column:
    """``form`` with the characters of class ``kept`` replaced by those of ``chars`` in turn."""

    def step(done: Column, char: Column) -> Column:
        takes = char.rlike(kept)
        new = F.when(takes, F.substr(chars, done["at"], F.lit(1))).otherwise(char)
        return F.struct(F.concat(done["text"], new).alias("text"), (done["at"] + takes.cast("int")).alias("at"))

    start = F.struct(F.lit("").alias("text"), F.lit(1).alias("at"))
    return F.aggregate(F.split(form, ""), start, step, lambda done: done["text"])


def _number(digits: Column, at: int, n: int) -> Column:
    return F.substring(digits, at, n).cast("bigint")


def _padded(number: Column, n: int) -> Column:
    return F.lpad(number.cast("string"), n, "0")


def _card(key: str, value: Column, digits: Column) -> tuple[Column, Column]:
    n = F.length(digits)
    check = n.between(13, 19) & (luhn_sum(digits) % 10 == 0)
    body = permuted_text(key, "card", F.substr(digits, F.lit(2), n - 2))
    body = F.concat(F.substring(digits, 1, 1), body)
    last = F.pmod(-luhn_sum(F.concat(body, F.lit("0"))), F.lit(10)).cast("string")
    return check, _refilled(value, F.concat(body, last))


def _iban(key: str, value: Column, digits: Column) -> tuple[Column, Column]:
    plain = F.regexp_replace(value, " ", "")
    country, account = F.substring(plain, 1, 2), F.substr(plain, F.lit(5), F.length(plain))
    check = value.rlike("^[A-Z]{2}[0-9]{2}[ A-Z0-9]+$") & (mod97(F.concat(account, F.substring(plain, 1, 4))) == 1)
    account = permuted_text(key, "iban", account)
    both = _padded(98 - mod97(F.concat(account, country, F.lit("00"))), 2)
    return check, _refilled(value, F.concat(country, both, account), "[A-Z0-9]")


def _phone(key: str, value: Column, digits: Column) -> tuple[Column, Column]:
    ten = F.substr(digits, F.length(digits) - 9, F.lit(10))
    form = r"^(?:\+?1[ .-]?)?(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[ .-])[2-9][0-9]{2}[ .-][0-9]{4}$"
    number = ((_number(ten, 1, 3) - 200) * 800 + _number(ten, 4, 3) - 200) * 10_000 + _number(ten, 7, 4)
    pair = permuted(key, "phone", F.floor(number / 80_000), number % 80_000, 80_000, 80_000)
    new = F.transform(F.array(pair), lambda p: p["l"] * 80_000 + p["r"])[0]
    text = F.transform(
        F.array(new),
        lambda x: F.concat(
            _padded(F.floor(x / 8_000_000) + 200, 3), _padded(F.floor(x / 10_000) % 800 + 200, 3), _padded(x % 10_000, 4)
        ),
    )[0]
    front = F.substr(digits, F.lit(1), F.length(digits) - 10)
    return value.rlike(form), _refilled(value, F.concat(front, text))


def _intl(key: str, value: Column, digits: Column) -> tuple[Column, Column]:
    rest = permuted_text(key, "intl", F.substr(digits, F.lit(3), F.length(digits)))
    check = value.startswith("+") & F.length(digits).between(8, 15)
    return check, _refilled(value, F.concat(F.substring(digits, 1, 2), rest))


def _ssn(key: str, value: Column, digits: Column) -> tuple[Column, Column]:
    area, group, serial = _number(digits, 1, 3), _number(digits, 4, 2), _number(digits, 6, 4)
    check = value.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$") & area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    place = area - 1 - (area > 666).cast("int")  # 898 areas
    pair = permuted(key, "ssn", place * 99 + group - 1, serial - 1, 898 * 99, 9_999)

    def text(p: Column) -> Column:
        found = F.floor(p["l"] / 99) + 1
        found = found + (found >= 666).cast("int")
        return F.concat_ws("-", _padded(found, 3), _padded(p["l"] % 99 + 1, 2), _padded(p["r"] + 1, 4))

    return check, F.transform(F.array(pair), text)[0]


def _ip(key: str, value: Column, digits: Column) -> tuple[Column, Column]:
    parts = F.transform(F.split(value, r"\."), lambda x: x.cast("bigint"))
    check = value.rlike(r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$") & F.forall(F.split(value, r"\."), lambda x: x.cast("bigint") <= 255)
    pair = permuted(key, "ip", parts[0] * 256 + parts[1], parts[2] * 256 + parts[3], 65_536, 65_536)
    text = lambda p: F.concat_ws(
        ".", *[(F.floor(p[side] / 256) if high else p[side] % 256).cast("string") for side in "lr" for high in (True, False)]
    )
    return check, F.transform(F.array(pair), text)[0]


def _is_day(year: Column, month: Column, day: Column) -> Column:
    leap = ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)
    days = F.when(month.isin(4, 6, 9, 11), 30).when(month == 2, 28 + leap.cast("int")).otherwise(31)
    return year.between(1800, 2199) & month.between(1, 12) & (day >= 1) & (day <= days)


def _new_day(key: str, year: Column, month: Column, day: Column) -> Column:
    first = F.lit("1800-01-01").cast("date")
    number = F.datediff(F.make_date(year, month, day), first)
    pair = permuted(key, "date", F.floor(number / 773), number % 773, 189, 773)
    return F.transform(F.array(pair), lambda p: F.date_add(first, (p["l"] * 773 + p["r"]).cast("int")))[0]


def _date(key: str, value: Column, digits: Column) -> tuple[Column, Column]:
    iso = value.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$")
    other = value.rlike("^[0-9]{1,2}[./][0-9]{1,2}[./][0-9]{4}$")
    parts = F.split(value, "[./-]")
    a, b, c = (F.when(iso | other, parts[i].cast("int")) for i in range(3))
    month_first = value.contains("/") & _is_day(c, a, b)
    year, month = F.when(iso, a).otherwise(c), F.when(iso | ~month_first, b).otherwise(a)
    day = F.when(iso, c).when(month_first, b).otherwise(a)
    mark = F.when(value.contains("/"), "/").otherwise(".")

    def text(new: Column) -> Column:
        wide = lambda part, i: F.lpad(part.cast("string"), F.greatest(F.length(part.cast("string")), F.length(parts[i])), "0")
        days, months = F.dayofmonth(new), F.month(new)
        first, second = F.when(month_first, months).otherwise(days), F.when(month_first, days).otherwise(months)
        return F.when(iso, F.date_format(new, "yyyy-MM-dd")).otherwise(
            F.concat(wide(first, 0), mark, wide(second, 1), mark, F.year(new).cast("string"))
        )

    return (iso | other) & _is_day(year, month, day), F.transform(F.array(_new_day(key, year, month, day)), text)[0]


def _email(key: str, value: Column, digits: Column) -> tuple[Column, Column]:
    local = F.substring_index(value, "@", 1)
    return value.contains("@"), F.concat(permuted_text(key, "email", local), F.lit("@"), F.substring_index(value, "@", -1))


_RULES: dict[str, Callable] = {
    "email": _email,
    "iban": _iban,
    "ip": _ip,
    "phone": _phone,
    "intl": _intl,
    "ssn": _ssn,
    "date": _date,
    "card": _card,
}


def pseudonym(key: str, value: Column) -> Column:
    """A struct (kind, text) for a value of one of the forms; kind is null if it fails its check."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    kind, text = F, F
    for name, rule in _RULES.items():
        check, new = rule(key, value, digits)
        kind, text = kind.when(check, name), text.when(check, new)
    return F.struct(kind.alias("kind"), text.otherwise(value).alias("text"))


def pseudonymise(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with the text rewritten, and ``pii`` = findings of each kind as a map.

    ``pii`` replaces a column of that name. The key is part of the plan, so keep plans and event logs as secret as the key.
    """
    content = F.col(f"`{text}`")
    found = F.when(content.rlike("[0-9@]"), F.regexp_extract_all(content, F.lit(FORM), F.lit(0)))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.coalesce(found, F.array().cast("array<string>")).alias("_found"))
    rows = rows.withColumn("_new", F.transform("_found", lambda value: pseudonym(key, value)))
    content = F.col(f"_row.`{text}`")
    between = F.split(content, FORM, -1)
    joined = F.array_join(F.flatten(F.zip_with(between, F.col("_new.text"), lambda x, y: F.array(x, F.coalesce(y, F.lit(""))))), "")
    rewritten = F.when(F.size("_found") == 0, content).otherwise(joined)
    number = lambda kind: F.size(F.filter("_new", lambda x: x["kind"] == kind)).cast("bigint")
    counts = F.map_from_arrays(F.array(*map(F.lit, KINDS)), F.array(*map(number, KINDS)))
    kept = [rewritten.alias(text) if c == text else F.col(f"_row.`{c}`").alias(c) for c in docs.columns if c != "pii"]
    return rows.select(*kept, counts.alias("pii"))
