"""The DataFrame form against a plain Python form of the same networks, and what they must keep."""

import datetime as dt
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from relforge.llm import pii as P

KEY = "test key"


def number(kind, *parts):
    text = "|".join([KEY, kind, *map(str, parts)])
    return int(hashlib.sha256(text.encode()).hexdigest()[:15], 16)


def network(left, right, a, b, kind):
    for i in range(P.ROUNDS):
        if i % 2 == 0:
            left = (left + number(kind, f"{i}/{a}/{b}", right)) % a
        else:
            right = (right + number(kind, f"{i}/{a}/{b}", left)) % b
    return left, right


def inverse(left, right, a, b, kind):
    for i in reversed(range(P.ROUNDS)):
        if i % 2 == 0:
            left = (left - number(kind, f"{i}/{a}/{b}", right)) % a
        else:
            right = (right - number(kind, f"{i}/{a}/{b}", left)) % b
    return left, right


def digits(value, kind):
    u = len(value) // 2
    left, right = network(int(value[:u]), int(value[u:]), 10**u, 10 ** (len(value) - u), kind)
    return f"{left:0{u}d}{right:0{len(value) - u}d}"


def luhn(value):
    return sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(map(int, reversed(value)))) % 10 == 0


def moved(day):
    index = day % 146_097
    left, right = network(index // 773, index % 773, 189, 773, "date")
    return day - index + left * 773 + right


def run(spark, texts, **kw):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.text for r in P.pseudonymize(df, key=KEY, **kw).orderBy("doc_id").collect()]


def test_digits_and_cards(spark):
    cards = ["4111111111111111", "5500005555555559", "340000000000009", "6011000990139424"]
    out = run(spark, [f"pay {c} now" for c in cards] + ["4111 1111 1111 1111, 4111-1111-1111-1111", "4111111111111112"])
    for c, o in zip(cards, out):
        new = re.search(r"\d+", o)[0]
        assert len(new) == len(c) and luhn(new) and new != c and new[:-1] == digits(c[:-1], "card")
        u = (len(c) - 1) // 2
        assert "".join(f"{x:0{n}d}" for x, n in zip(inverse(int(new[:u]), int(new[u:-1]), 10**u, 10 ** (len(c) - 1 - u), "card"), (u, len(c) - 1 - u))) == c[:-1]
    first = re.search(r"\d+", out[0])[0]
    assert out[4] == f"{first[:4]} {first[4:8]} {first[8:12]} {first[12:]}, {first[:4]}-{first[4:8]}-{first[8:12]}-{first[12:]}"
    assert out[5] == "4111111111111112"  # not valid, so not a card


def test_dates(spark):
    texts = ["2023-02-28", "28.02.2023", "1999/12/31", "3/4/1999", "02/28/2023", "2023-02-30", "31.12.2500"]
    out = run(spark, texts)
    day = (dt.date(2023, 2, 28) - dt.date(2000, 1, 1)).days
    new = dt.date(2000, 1, 1) + dt.timedelta(moved(day))
    assert out[0] == new.isoformat() and out[1] == new.strftime("%d.%m.%Y")
    assert dt.datetime.strptime(out[2], "%Y/%m/%d") and out[5:] == texts[5:]
    walked = moved(day)
    while (dt.date(2000, 1, 1) + dt.timedelta(walked)).day <= 12:
        walked = moved(walked)
    assert out[4] == (dt.date(2000, 1, 1) + dt.timedelta(walked)).strftime("%m/%d/%Y")
    assert re.fullmatch(r"\d{1,2}/\d{1,2}/\d{4}", out[3])


@pytest.mark.parametrize("a, b, kind", [(7, 11, "x"), (1, 5, "y"), (16, 16, "z")])
def test_network_is_a_permutation(spark, a, b, kind):
    df = spark.range(a * b).select(P.feistel(F.floor(F.col("id") / b), F.col("id") % b, F.lit(a), F.lit(b), kind, KEY).alias("p"), "id")
    got = {r.id: (r.p.l, r.p.r) for r in df.collect()}
    assert len(set(got.values())) == a * b
    assert all(got[i] == network(i // b, i % b, a, b, kind) for i in got)


def test_other_kinds(spark):
    texts = ["write to Jane.Doe42@mail.example.org, Jane.Doe42@mail.example.org!", "call +1 (942) 555-5600 or (942) 555-5600", "from 10.20.30.255. Not 300.1.1.1",
             "ssn 123-45-6789, not 666-45-6789", "GB82 WEST 1234 5698 7654 32 or GB82WEST12345698765433", 'token = "F231efbfd1fdb295f161be24c505140eae764acc"']
    out = run(spark, texts)
    mails = re.findall(r"[A-Z][a-z]{3}\.[A-Z][a-z]{2}\d\d@mail\.example\.org", out[0])
    assert len(mails) == 2 and mails[0] == mails[1] and "Jane" not in out[0]
    assert re.fullmatch(r"call \+1 \(\d{3}\) \d{3}-\d{4} or \(\d{3}\) \d{3}-\d{4}", out[1])
    assert re.findall(r"\d{3}\) \d{3}-\d{4}", out[1])[0] == re.findall(r"\d{3}\) \d{3}-\d{4}", out[1])[1]  # linked
    octets = re.match(r"from (\d+)\.(\d+)\.(\d+)\.(\d+)\. Not 300\.1\.1\.1$", out[2]).groups()
    left, right = network(10 * 256 + 20, 30 * 256 + 255, 65536, 65536, "ipv4")
    assert list(map(int, octets)) == [left >> 8, left & 255, right >> 8, right & 255]
    area, group, serial = map(int, re.match(r"ssn (\d{3})-(\d\d)-(\d{4}), not 666-45-6789$", out[3]).groups())
    assert 0 < area < 900 and area != 666 and group and serial
    iban = re.match(r"([A-Z]{2}\d\d [A-Z]{4} \d{4} \d{4} \d{4} \d\d) or GB82WEST12345698765433$", out[4])[1].replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1
    assert re.fullmatch(r'token = "[A-F][0-9a-f]{39}"', out[5]) and out[5] != texts[5]


def test_valid_values_beside_what_looks_like_a_part(spark):
    es, be, card = "ES9121000418450200051332", "BE68 5390 0754 7034", "4111 1111 1111 1111"
    texts = [f"{es} BIC CAIXESBBXXX", f"expires 2027 {card}", f"{be} A1 now", f"{es} {card}", f"ref AB12 3456 7890 {card}", f"1234 5678 9012 3456 7890 {card} 123, 2027-{card.replace(' ', '-')}",
             f"AT61 1904 3002 3457 3201 {be}", f"+49 {card}", f"{card} 12.05.2023 and {card} 123-45-6789", f"{card} 1234@mail.example.org", f"2027 {card}.5", "2027 4111 1111 1111 1112"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [(r.text, r.kinds) for r in P.pseudonymize(df, key=KEY, found_col="kinds").orderBy("doc_id").collect()]
    alone = [es, be, card, "12.05.2023", "123-45-6789", "1234@mail.example.org", "AT61 1904 3002 3457 3201"]
    new = dict(zip(alone, run(spark, alone)))
    assert all(a != b and len(a) == len(b) for a, b in new.items() if "." not in a)
    new[card.replace(" ", "-")] = new[card].replace(" ", "-")
    for text, (out, _) in zip(texts, got):
        for a, b in new.items():
            text = text.replace(a, b)
        assert out == text
    assert [k for _, k in got] == [["iban"], ["card"], ["iban"], ["iban", "card"], ["card"], ["card", "card"], ["iban", "iban"], ["card"], ["card", "date", "card", "ssn"], ["card", "email"], ["card"], []]


def test_telephone_numbers_stay_linked_in_any_layout(spark):
    us, de, ie = ["+1 555 123 4567", "+15551234567", "+1 (555) 123-4567", "+1-555-123-4567", "(555) 123-4567", "555-123-4567"], ["+49 30 1234 5678", "+493012345678", "+4930 12345678"], ["+353 1234 5678 90", "+353123456 7890"]
    out = run(spark, us + de + ie)
    assert all(len(a) == len(b) and re.sub(r"\d", "0", a) == re.sub(r"\d", "0", b) for a, b in zip(us + de + ie, out))
    bare = [re.sub(r"\D", "", x) for x in out]
    want = [digits("5551234567", "phone"), "49" + digits("3012345678", "phone"), "353" + digits("1234567890", "phone")]
    assert bare[:4] == ["1" + want[0]] * 4 and bare[4:6] == [want[0]] * 2
    assert bare[6:9] == [want[1]] * 3 and bare[9:] == [want[2]] * 2


def test_odd_rows(spark, odd_docs, no_docs):
    out = P.pseudonymize(odd_docs, found_col="kinds")
    assert out.columns == [*odd_docs.columns, "kinds"]
    assert sorted(map(str, (r.text for r in out.collect()))) == sorted(map(str, (r.text for r in odd_docs.collect())))
    assert P.pseudonymize(no_docs).count() == 0


def test_plan_has_no_python(spark, odd_docs):
    plan = P.pseudonymize(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def test_long_tokens_take_linear_time(spark):
    out = run(spark, ["a" * 400_000, "1" * 200_000, "a.b" * 100_000 + "@"])
    assert [len(x) for x in out] == [400_000, 200_000, 300_001]


def test_long_runs_of_groups(spark):
    out = run(spark, ["1234 5678 " * 10_000, "AB12 3456 " * 10_000])
    assert [len(x) for x in out] == [100_000, 100_000]


def test_addresses_are_linked_in_any_case(spark):
    texts = ["JOHN.doc7@mail.org", "john.doc7@mail.org", "John.Doc7@mail.org and jOHN.dOC7@mail.org"]
    out = [r.text for r in P.pseudonymize(spark.createDataFrame([(t,) for t in texts], "text string"), key=KEY).collect()]
    names = [n for t in out for n in re.findall(r"[\w.]+(?=@mail\.org)", t)]
    assert len(names) == 4 and len({n.lower() for n in names}) == 1 and names[0].lower() != "john.doc7"
    assert [re.sub("[A-Z]", "U", re.sub("[a-z]", "l", re.sub("[0-9]", "0", n))) for n in names] == ["UUUU.lll0", "llll.lll0", "Ulll.Ull0", "lUUU.lUU0"]
