"""Format-preserving pseudonyms for personal data, in DataFrame functions only (operator 2).

Found in a whole text by one pattern, then validated: e-mail addresses, IBANs (mod 97), card numbers
(Luhn), IPv4 addresses (octets to 255), US social security numbers (valid areas), telephone numbers,
dates (calendar, years 1600-2399) and long hexadecimal secrets. What does not validate stays as it is.

IBANs and cards are looked for again inside the run of groups they were met in, since a number or a short word
beside them can look like a part: at each start the IBAN of its country's length, the longest that its pattern
finds and the card are validated, from left to right; what lies between the valid ones is searched for the other
kinds. A telephone number of too many digits is searched for cards in the same way.

Each value is permuted within its own format by a keyed Feistel network, so a valid value becomes
another valid one and equal values become equal ones, in every document and in any layout (but for dates
written month first, below):

- digits (telephone, card): two halves of the digits are added, in turn, to a keyed hash of the other,
  modulo 10^length; a card's last digit is set so that Luhn holds; separators stay where they were; the
  country code of a telephone number stays, split off by the table of codes whatever the layout;
- IPv4 over 2^16 x 2^16, social security numbers over the 898 * 99 x 9999 valid ones;
- dates over the 146,097 days of their 400-year cycle, as 189 x 773; dates written month first walk the
  cycle until the day is over 12 again, so that the result reads month first too, and is the day of the same
  date in another layout only if that one is over 12;
- letters and digits (the local part of an address, an account, a secret): the halves shift each other
  character by character within the character's class.

The hash is SHA-256 of key, kind, round and value. The key is a parameter; whoever has it can invert
the network. Everything runs in each row on its own: no shuffle, no Python worker.

Defined results: null text stays null, with 0 found; an empty text stays empty; rows repeat as given;
extra columns are carried.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, free_name

ROUNDS = 8
KEY = "relforge-demo-key"

_L, _R = r"(?<![A-Za-z0-9])", r"(?![A-Za-z0-9])"
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,8}\.[A-Za-z]{2,24}" + _R
IBAN = _L + r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?" + _R
SECRET = _L + r"[0-9a-fA-F]{32,64}+" + _R
IPV4 = r"(?<![A-Za-z0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[A-Za-z0-9])"
YMD = _L + r"[0-9]{4}([-/.])[0-9]{1,2}\1[0-9]{1,2}" + _R
DMY = _L + r"[0-9]{1,2}([-/.])[0-9]{1,2}\2[0-9]{4}" + _R
PHONE = (r"(?<![A-Za-z0-9+])\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?(?:[ .-]?[0-9]{2,4}){2,3}" + _R
         + r"|(?<![A-Za-z0-9(])\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}" + _R + "|" + _L + r"[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}" + _R)
#: country codes of telephone numbers; all others have three digits
COUNTRY = r"[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3}"
SSN = _L + r"[0-9]{3}-[0-9]{2}-[0-9]{4}" + _R
CARD = (_L + r"[0-9]{4}(?: [0-9]{4}){2} [0-9]{1,7}" + _R + "|" + _L + r"[0-9]{4}(?:-[0-9]{4}){2}-[0-9]{1,7}" + _R
        + "|" + _L + r"[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}" + _R + "|" + _L + r"[0-9]{13,19}+" + _R)
#: length of an IBAN -> its countries
IBAN_LENGTHS = {
    15: "NO", 16: "BE BI", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BF BJ CI DJ DZ FR GR IT MC MR SM SN", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}


def _of_length(n: int) -> str:
    groups, rest = divmod(n - 4, 4)
    return "[0-9]{2}(?: ?[A-Z0-9]{4}){%d}" % groups + (" ?[A-Z0-9]{%d}" % rest if rest else "")


_LISTED = "|".join(IBAN_LENGTHS.values()).replace(" ", "|")
#: what may be an IBAN or a card at a start, in the order of trial: country's length, longest, longest of whole groups
TRIES = (_L + "(?:" + "|".join(f"(?:{c.replace(' ', '|')}){_of_length(n)}" for n, c in IBAN_LENGTHS.items()) + ")" + _R, IBAN,
         _L + f"(?!{_LISTED})" + r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}" + _R, CARD)
#: the longest of TRIES, with 7 blanks
_WIDEST = 48
#: an IBAN or a card with the groups behind it, up to one that begins a date, an IPv4 or an e-mail address
_TO_GROUP = r"(?:[ -][A-Z0-9 -]*[A-Z0-9](?![A-Za-z0-9]|[./][0-9]{1,3}[./][0-9]|[A-Za-z0-9._%+-]{0,64}@))?"
_OTHERS = (IPV4, YMD, DMY, SSN, PHONE)
REST = "|".join((EMAIL, SECRET, *_OTHERS))
ANY = "|".join((EMAIL, SECRET, f"(?:{IBAN}){_TO_GROUP}", *_OTHERS, f"(?:{CARD}){_TO_GROUP}"))


def _hash(kind: str, key: str, *parts: Column) -> Column:
    """Hexadecimal SHA-256 of key, kind and parts."""
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), *parts).cast("binary"), 256)


def _number(kind: str, key: str, *parts: Column) -> Column:
    return F.conv(F.substring(_hash(kind, key, *parts), 1, 15), 16, 10).cast("long")


def feistel(left: Column, right: Column, a: Column, b: Column, kind: str, key: str) -> Column:
    """The keyed permutation of pairs (left in 0..a-1, right in 0..b-1), as struct(l, r)."""

    def step(s: Column, i: Column) -> Column:
        low, high = i % 2 == 0, i % 2 == 1
        left, right = s["l"], s["r"]
        tag = F.concat_ws("/", i, a, b)
        new_l = F.when(low, F.pmod(left + _number(kind, key, tag, right), a)).otherwise(left)
        new_r = F.when(high, F.pmod(right + _number(kind, key, tag, left), b)).otherwise(right)
        return F.struct(new_l.alias("l"), new_r.alias("r"))

    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    return F.aggregate(F.array(*map(F.lit, range(ROUNDS))), start, step)


def _power(n: Column) -> Column:
    """10^n for n up to 18, exactly."""
    return F.concat(F.lit("1"), F.repeat(F.lit("0"), n)).cast("long")


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def permute_digits(digits: Column, kind: str, key: str) -> Column:
    """A string of 2 to 36 digits as another of the same length."""
    n = F.length(digits)
    u = F.floor(n / 2).cast("int")
    left, right = F.substring(digits, F.lit(1), u), F.substring(digits, u + 1, n - u)
    pair = feistel(left.cast("long"), right.cast("long"), _power(u), _power(n - u), kind, key)
    return _bind(pair, lambda s: F.concat(F.lpad(s["l"].cast("string"), u, F.lit("0")), F.lpad(s["r"].cast("string"), n - u, F.lit("0"))))


def _fill(layout: Column, digits: Column) -> Column:
    """The layout with its digits replaced, in order."""

    def step(s: Column, c: Column) -> Column:
        is_digit = c.between("0", "9")
        out = F.concat(s["out"], F.when(is_digit, F.substring(digits, s["k"], F.lit(1))).otherwise(c))
        return F.struct(out.alias("out"), (s["k"] + is_digit.cast("int")).alias("k"))

    return F.aggregate(F.split(layout, ""), F.struct(F.lit("").alias("out"), F.lit(1).alias("k")), step)["out"]


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn_sum(digits: Column) -> Column:
    """Sum of the digits, every second from the right doubled."""
    n = F.length(digits)

    def step(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), step)


def _card(m: Column, key: str) -> Column:
    def made(d: Column) -> Column:
        payload = permute_digits(F.substring(d, F.lit(1), F.length(d) - 1), "card", key)
        whole = _bind(payload, lambda p: F.concat(p, ((10 - luhn_sum(F.concat(p, F.lit("0"))) % 10) % 10).cast("string")))
        return F.when(_card_holds(d), _fill(m, whole))

    return _bind(_digits(m), made)


def _phone(m: Column, key: str) -> Column:
    def made(d: Column) -> Column:
        country = F.when(m.startswith("+"), F.regexp_extract(d, "^(?:" + COUNTRY + ")", 0)).otherwise("")

        def moved(c: Column) -> Column:
            rest = F.substring(d, F.length(c) + 1, F.length(d))
            holds = (F.length(d) >= F.when(m.startswith("+"), 8).otherwise(7)) & F.length(rest).between(2, 15)
            return F.when(holds, _fill(m, F.concat(c, permute_digits(rest, "phone", key))))

        return _bind(country, moved)

    return _bind(_digits(m), made)


def _ipv4(m: Column, key: str) -> Column:
    def made(o: Column) -> Column:
        octet = [o[i].cast("int") for i in range(4)]
        pair = feistel(octet[0] * 256 + octet[1], octet[2] * 256 + octet[3], F.lit(65536), F.lit(65536), "ipv4", key)
        text = lambda s: F.concat_ws(".", *(x.cast("string") for x in (F.shiftright(s["l"], 8), s["l"] % 256, F.shiftright(s["r"], 8), s["r"] % 256)))
        valid = F.forall(o, lambda x: x.cast("int") <= 255)
        return F.when(valid, _bind(pair, text))

    return _bind(F.split(m, r"\."), made)


def _ssn(m: Column, key: str) -> Column:
    area, group, serial = (F.substring(m, i, n).cast("int") for i, n in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    index = area - 1 - (area > 666).cast("int")
    pair = feistel(index * 99 + group - 1, serial - 1, F.lit(898 * 99), F.lit(9999), "ssn", key)

    def text(s: Column) -> Column:
        i = F.floor(s["l"] / 99)
        return F.format_string("%03d-%02d-%04d", (i + 1 + (i >= 665).cast("int")).cast("long"), s["l"] % 99 + 1, s["r"] + 1)

    return F.when(valid, _bind(pair, text))


_EPOCH = "2000-01-01"
_CYCLE = 146_097  # days of 400 years, 189 * 773


def _moved(day: Column, key: str) -> Column:
    """Another day of the same 400-year cycle (days count from 2000-01-01)."""
    index = F.pmod(day, F.lit(_CYCLE))
    pair = feistel(F.floor(index / 773), index % 773, F.lit(189), F.lit(773), "date", key)
    return day - index + _bind(pair, lambda s: s["l"] * 773 + s["r"])


def _date(m: Column, key: str, year_first: bool) -> Column:
    def made(p: Column) -> Column:
        year, x, y = (p[0], p[1], p[2]) if year_first else (p[2], p[0], p[1])
        # year first: month, day; else day, month, unless the second number is over 12
        swapped = F.lit(False) if year_first else y.cast("int") > 12
        month, day = (x, y) if year_first else (F.when(swapped, x).otherwise(y), F.when(swapped, y).otherwise(x))
        two = lambda v: F.lpad(v.cast("string"), 2, "0")
        parsed = F.try_to_date(F.concat_ws("-", year, two(month), two(day)), "yyyy-MM-dd")
        days = F.datediff(parsed, F.lit(_EPOCH).cast("date")).cast("long")
        first = _moved(days, key)
        back = lambda d: F.date_add(F.lit(_EPOCH).cast("date"), d.cast("int"))
        walked = F.aggregate(F.sequence(F.lit(1), F.lit(64)), first,
                             lambda d, _: F.when(swapped & (F.dayofmonth(back(d)) <= 12), _moved(d, key)).otherwise(d))
        wide = (F.length(x) == 2) & (F.length(y) == 2)

        def text(d: Column) -> Column:
            pad = lambda v: F.when(wide, two(v)).otherwise(v.cast("string"))
            mm, dd = pad(F.month(d)), pad(F.dayofmonth(d))
            yy = F.lpad(F.year(d).cast("string"), 4, "0")
            sep = F.regexp_extract(m, "([-/.])", 1)
            parts = (yy, mm, dd) if year_first else (F.when(swapped, mm).otherwise(dd), F.when(swapped, dd).otherwise(mm), yy)
            return F.concat(parts[0], sep, parts[1], sep, parts[2])

        return F.when(parsed.isNotNull() & year.cast("int").between(1600, 2399), _bind(back(walked), text))

    return _bind(F.split(m, "[-/.]"), made)


def _shift_half(half: Column, other: Column, tag: Column, kind: str, key: str, letters: int) -> Column:
    """Each letter or digit of a half, up to 32, moved within its class by the hash of the other half."""

    def moved(c: Column, i: Column, h: Column) -> Column:
        by = F.conv(F.substring(h, 2 * i + 1, F.lit(2)), 16, 10).cast("int")
        code = F.ascii(c)
        near = lambda base, size: F.char((base + F.pmod(code - base + by, F.lit(size))).cast("long"))
        return (F.when(code.between(48, 57), near(48, 10)).when(code.between(65, 64 + letters), near(65, letters))
                .when(code.between(97, 96 + letters), near(97, letters)).otherwise(c))

    chars = F.split(half, "")
    return F.when(half == "", half).otherwise(
        _bind(_hash(kind, key, tag, other), lambda h: F.array_join(F.transform(chars, lambda c, i: moved(c, i, h)), "")))


def permute_letters(value: Column, kind: str, key: str, letters: int = 26) -> Column:
    """A string of up to 64 characters with every letter and digit moved within its class."""
    n = F.length(value)
    u = F.floor(n / 2).cast("int")
    start = F.struct(F.substring(value, F.lit(1), u).alias("l"), F.substring(value, u + 1, n - u).alias("r"))

    def step(s: Column, i: Column) -> Column:
        tag = F.concat_ws("/", i, n)
        left = F.when(i % 2 == 0, _shift_half(s["l"], s["r"], tag, kind, key, letters)).otherwise(s["l"])
        right = F.when(i % 2 == 1, _shift_half(s["r"], s["l"], tag, kind, key, letters)).otherwise(s["r"])
        return F.struct(left.alias("l"), right.alias("r"))

    return _bind(F.aggregate(F.array(*map(F.lit, range(ROUNDS))), start, step), lambda s: F.concat(s["l"], s["r"]))


def _email(m: Column, key: str) -> Column:
    """An address is the same one in any case; capitals stay where they are."""
    local = F.substring_index(m, "@", 1)

    def cased(moved: Column) -> Column:
        if_capital = lambda c, i: F.when((c >= "A") & (c <= "Z"), F.upper(F.substring(moved, i + 1, F.lit(1)))).otherwise(F.substring(moved, i + 1, F.lit(1)))
        return F.array_join(F.transform(F.split(local, ""), if_capital), "")

    whole = _bind(permute_letters(F.lower(local), "email", key), lambda moved: F.when(local.rlike("[A-Z]"), cased(moved)).otherwise(moved))
    return F.concat(whole, F.lit("@"), F.substring_index(m, "@", -1))


def _mod97(value: Column) -> Column:
    def step(total: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code < 65, (total * 10 + code - 48) % 97).otherwise((total * 100 + code - 55) % 97)

    return F.aggregate(F.split(value, ""), F.lit(0), step)


def _iban_holds(v: Column) -> Column:
    return F.length(v).between(15, 34) & (_mod97(F.concat(F.substring(v, F.lit(5), F.length(v)), F.substring(v, 1, 4))) == 1)


def _card_holds(d: Column) -> Column:
    return F.length(d).between(13, 19) & (luhn_sum(d) % 10 == 0)


def _iban(m: Column, key: str) -> Column:
    def made(v: Column) -> Column:
        country, account = F.substring(v, 1, 2), F.substring(v, F.lit(5), F.length(v))
        valid = _iban_holds(v)
        moved = permute_letters(account, "iban", key)
        whole = _bind(moved, lambda a: F.concat(country, F.lpad((98 - _mod97(F.concat(a, country, F.lit("00")))).cast("string"), 2, "0"), a))

        def laid_out(w: Column) -> Column:  # blanks where they were
            def step(s: Column, c: Column) -> Column:
                blank = c == " "
                return F.struct(F.concat(s["out"], F.when(blank, c).otherwise(F.substring(w, s["k"], F.lit(1)))).alias("out"),
                                (s["k"] + F.when(blank, 0).otherwise(1)).alias("k"))
            return F.aggregate(F.split(m, ""), F.struct(F.lit("").alias("out"), F.lit(1).alias("k")), step)["out"]

        return F.when(valid, _bind(whole, laid_out))

    return _bind(F.replace(m, F.lit(" "), F.lit("")), made)


def _is(m: Column, pattern: str) -> Column:
    return m.rlike("^(?:" + pattern + ")$")


def pseudonym(m: Column, key: str = KEY) -> Column:
    """struct(kind, value): the pseudonym of a found string, or the string itself with a null kind."""
    has_digit_run = _is(m, CARD)
    tries = [
        ("email", m.contains("@"), _email(m, key)),
        ("secret", _is(m, "[0-9a-fA-F]{32,64}") & m.rlike("[0-9]") & m.rlike("[a-fA-F]"), permute_letters(m, "secret", key, letters=6)),
        ("ipv4", _is(m, r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}"), _ipv4(m, key)),
        ("date", _is(m, r"[0-9]{4}([-/.])[0-9]{1,2}\1[0-9]{1,2}"), _date(m, key, True)),
        ("date", _is(m, r"[0-9]{1,2}([-/.])[0-9]{1,2}\1[0-9]{4}"), _date(m, key, False)),
        ("ssn", _is(m, "[0-9]{3}-[0-9]{2}-[0-9]{4}"), _ssn(m, key)),
        ("iban", m.rlike("^[A-Z]{2}[0-9]{2}"), _iban(m, key)),
        ("card", has_digit_run, _card(m, key)),
        ("phone", F.lit(True), _phone(m, key)),
    ]
    # the kind is settled first, so that only its own expression is evaluated
    out = F.lit(None).cast("struct<kind:string,value:string>")
    for kind, test, value in reversed(tries):
        out = F.when(test, F.struct(F.lit(kind).alias("kind"), value.alias("value"))).otherwise(out)
    return _bind(out, lambda s: F.struct(F.when(s["value"].isNotNull(), s["kind"]).alias("kind"), F.coalesce(s["value"], m).alias("value")))


def _runs(m: Column) -> Column:
    """A run of groups as array of struct(known, text): its valid IBANs and cards, and what lies between them."""
    parts = F.split(F.regexp_replace(m, "(?=" + "|".join(TRIES) + ")", "\n"), "\n", -1)  # a run holds no line end

    def holds(c: Column) -> Column:
        return F.when(c.rlike("^[A-Z]"), _iban_holds(F.replace(c, F.lit(" "), F.lit("")))).otherwise(_card_holds(_digits(c)))

    def begins(w: Column) -> Column:
        return F.get(F.filter(F.array(*(F.regexp_extract(w, "^(?:" + t + ")", 0) for t in TRIES)), lambda c: (c != "") & holds(c)), F.lit(0))

    def split(parts: Column) -> Column:
        window = lambda i: F.substring(F.array_join(F.slice(parts, i + 1, _WIDEST), ""), 1, _WIDEST)
        tried = F.transform(parts, lambda p, i: F.struct(p.alias("p"), F.when(i > 0, _bind(window(i), begins)).alias("c")))
        piece = lambda known, text: F.array(_piece(known, text))

        def step(s: Column, x: Column) -> Column:  # skip: characters of the last value that are still to come
            new = (s["skip"] == 0) & x["c"].isNotNull()
            ahead = F.when(new, F.length(x["c"])).otherwise(s["skip"])
            rest = F.substring(x["p"], ahead + 1, F.length(x["p"]))
            out = F.when(new, F.concat(s["out"], piece(False, s["open"]), piece(True, x["c"]))).otherwise(s["out"])
            return F.struct(F.greatest(ahead - F.length(x["p"]), F.lit(0)).alias("skip"), F.when(new, rest).otherwise(F.concat(s["open"], rest)).alias("open"), out.alias("out"))

        none = F.array().cast("array<struct<known:boolean,text:string>>")
        start = F.struct(F.lit(0).alias("skip"), F.lit("").alias("open"), none.alias("out"))
        return F.aggregate(tried, start, step, lambda s: F.concat(s["out"], piece(False, s["open"])))

    return _bind(parts, split)


def _piece(known: bool, text: Column) -> Column:
    return F.struct(F.lit(known).alias("known"), text.alias("text"))


def _between(text: Column) -> Column:
    """Array of struct(known, text) of a text that holds no valid IBAN or card."""
    pieces = F.split(text, REST, -1)

    def mixed(found: Column) -> Column:
        return F.flatten(F.transform(pieces, lambda p, i: F.when(i < F.size(found), F.array(_piece(False, p), _piece(True, F.get(found, i)))).otherwise(F.array(_piece(False, p)))))

    return _bind(F.regexp_extract_all(text, F.lit(REST), F.lit(0)), mixed)


def _parts(m: Column) -> Column:
    """Array of struct(known, text): a string found by ``ANY``, cut into what is to be validated and what stays."""
    run = m.rlike("^(?:" + IBAN + "|" + CARD + ")") | (m.startswith("+") & (F.length(_digits(m)) > 15))
    other = m.contains("@") | _is(m, SECRET)
    cut = F.flatten(F.transform(_runs(m), lambda s: F.when(s["known"], F.array(_piece(True, s["text"]))).otherwise(_between(s["text"]))))
    return F.when(run & ~other, cut).otherwise(F.array(_piece(True, m)))


def pseudonymize(docs: DataFrame, text_col: str = "text", key: str = KEY, found_col: str | None = None) -> DataFrame:
    """``docs`` with the text's personal data replaced; with ``found_col`` also the kinds found, in order."""
    text = col(text_col)
    listed, made = free_name(docs, "_pii_found"), free_name(docs, "_pii_text")
    # most texts hold no digit and no @, and need no further look
    none = F.lit(None).cast("string")
    each = lambda x: F.when(x["known"], pseudonym(x["text"], key)).otherwise(F.struct(none.alias("kind"), x["text"].alias("value")))
    found = F.when(text.rlike("[0-9@]"), F.transform(F.regexp_extract_all(text, F.lit(ANY), F.lit(0)), lambda m: F.transform(_parts(m), each)))
    rest = docs.withColumn(listed, found)
    pieces = F.split(text, ANY, -1)
    values = F.concat(F.transform(F.col(listed), lambda s: F.array_join(s["value"], "")), F.array(F.lit("")))
    new = F.when(F.size(listed) > 0, F.array_join(F.transform(pieces, lambda p, i: F.concat(p, values[i])), "")).otherwise(text)
    out = rest.withColumn(made, new)
    kinds = F.filter(F.transform(F.flatten(F.col(listed)), lambda s: s["kind"]), lambda k: k.isNotNull())
    keep = [col(c) if c != text_col else F.col(made).alias(text_col) for c in docs.columns if c != found_col]
    return out.select(*keep, *([F.coalesce(kinds, F.array().cast("array<string>")).alias(found_col)] if found_col else []))
