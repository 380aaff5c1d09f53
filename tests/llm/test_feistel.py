"""Operator 10: the native permutations against a plain Python version, and their properties."""

import datetime as dt
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from lexiflow.llm import feistel as Z
from lexiflow.llm.queries import op10_feistel
from tests.conftest import SF_SMALL

KEY = "test key"


def permute(kind, a, b, size_a, size_b):
    for r in range(Z.ROUNDS):
        x = b if r % 2 == 0 else a
        h = int(hashlib.sha256(f"{KEY}:{kind}:{r}:{x}".encode()).hexdigest()[:15], 16)
        if r % 2 == 0:
            a = (a + h) % size_a
        else:
            b = (b + h) % size_b
    return a, b


def luhn(payload):
    total = 0
    for i, d in enumerate(reversed(payload)):
        d = int(d) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def put(shape, digits):
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in shape)


def card(m):
    d = re.sub(r"\D", "", m)
    if luhn(d[:-1]) != d[-1]:
        return m
    n = len(d) - 2
    h = n // 2
    a, b = permute("card", int(d[1 : 1 + h]), int(d[1 + h : -1]), 10**h, 10 ** (n - h))
    payload = d[0] + f"{a:0{h}d}" + f"{b:0{n - h}d}"
    return put(m, payload + luhn(payload))


def ip(m):
    o = [int(x) for x in m.split(".")]
    a, b = permute("ipv4", o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536)
    return f"{a // 256}.{a % 256}.{b // 256}.{b % 256}"


def phone(m):
    d = re.sub(r"\D", "", m)
    t = d[-10:]
    if int(t[:3]) < 200 or int(t[3:6]) < 200:
        i = int(t) if int(t[:3]) < 200 else 2 * 10**9 + (int(t[:3]) - 200) * 2 * 10**6 + int(t[3:])
        a, b = permute("phone2", i // 60000, i % 60000, 60000, 60000)
        i = a * 60000 + b
        new = i if i < 2 * 10**9 else (200 + (i - 2 * 10**9) // (2 * 10**6)) * 10**7 + (i - 2 * 10**9) % (2 * 10**6)
        return put(m, d[:-10] + f"{new:010d}")
    a, b = permute("phone", int(t[:3]) - 200, (int(t[3:6]) - 200) * 10000 + int(t[6:]), 800, 8_000_000)
    return put(m, d[:-10] + f"{a + 200}{b // 10000 + 200}{b % 10000:04d}")


def day(value):
    i = (value - dt.date(1800, 1, 1)).days
    a, b = permute("date", i % 27, i // 27, 27, 5411)
    return dt.date(1800, 1, 1) + dt.timedelta(b * 27 + a)


def run(spark, texts, **kw):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return [r.text for r in Z.pseudonymise(df, KEY, **kw).orderBy("doc_id").collect()]


def test_each_kind_against_the_plain_version(spark):
    cards = ["4537960215852590", "4537-9602-1585-2590", "378282246310005", "6011 1111 1111 1117", "4537960215852591"]
    ips = ["23.200.152.31", "0.0.0.0", "255.255.255.255"]
    phones = ["+1 (863) 555-0950", "863-555-0950", "+18635550950", "(863) 555-0950", "+1 (139) 555-2766", "+1 (639) 055-2766"]
    got = run(spark, [f"x {v}, y" for v in cards + ips + phones])
    want = [f"x {f(v)}, y" for f, vs in ((card, cards), (ip, ips), (phone, phones)) for v in vs]
    assert got == want
    assert got[4] == "x 4537960215852591, y"  # fails its check digit: not a card


def test_dates_keep_their_notation_and_link(spark):
    new = day(dt.date(2020, 2, 29))
    got = run(spark, ["on 2020-02-29.", "02/29/2020", "29/02/2020", "29.02.2020", "2/29/2020", "2020-13-01", "1799-12-31", "30.02.2020"])
    assert got[:5] == [
        f"on {new:%Y-%m-%d}.", f"{new:%m/%d/%Y}", f"{new:%d/%m/%Y}", f"{new:%d.%m.%Y}", f"{new.month}/{new.day}/{new.year}",
    ]
    assert got[5:] == ["2020-13-01", "1799-12-31", "30.02.2020"]


def test_permutations_are_one_to_one_and_stay_in_format(spark):
    days = spark.range(0, 146097, 7).select(F.date_format(F.date_add(F.lit("1800-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("text"))
    out = Z.pseudonymise(days, KEY).where("text rlike '^[0-9]{4}-[0-9]{2}-[0-9]{2}$' and try_to_timestamp(text, 'yyyy-MM-dd') is not null")
    assert out.select("text").distinct().count() == days.count()
    ssns = spark.range(1, 20000).select(F.format_string("%03d-%02d-%04d", F.col("id") % 899 + 1, F.col("id") % 99 + 1, F.col("id") % 9999 + 1).alias("text"))
    ssns = ssns.where("text not like '666%'").distinct()
    out = Z.pseudonymise(ssns, KEY).where("text rlike '^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$' and n_replaced <= 1")
    assert out.select("text").distinct().count() == ssns.count()


def test_mail_keeps_shape_and_domain(spark):
    got = run(spark, ["to poeolp.83@mail8.example.com and Poeolp.83@mail8.example.com", "a@b.example.org", "poeolp.83@mail8.example.com"])
    first = got[0].split()
    assert re.fullmatch(r"[a-z]{6}\.\d\d@mail8\.example\.com", first[1]) and first[1] != "poeolp.83@mail8.example.com"
    assert got[2] == first[1] and got[1].endswith("@b.example.org")


def test_neighbours_do_not_hide_a_value(spark):
    card_, tel = "4537960215852590", "863-555-0950"
    iso = lambda y, m, d: f"{day(dt.date(y, m, d)):%Y-%m-%d}"
    cases = {
        f"{card_},12/2025": f"{card(card_)},12/2025",
        f"7,{card_},8": f"7,{card(card_)},8",
        f"{tel},{tel}": f"{phone(tel)},{phone(tel)}",
        f"{tel}/{tel}": f"{phone(tel)}/{phone(tel)}",
        "2024-01-05T10:00:00": f"{iso(2024, 1, 5)}T10:00:00",
        "2024-01-05Z": f"{iso(2024, 1, 5)}Z",
        "2019-01-01/2019-12-31": f"{iso(2019, 1, 1)}/{iso(2019, 12, 31)}",
        "10.0.0.1/24": f"{ip('10.0.0.1')}/24",
        "10.0.0.1:8080,10.0.0.2": f"{ip('10.0.0.1')}:8080,{ip('10.0.0.2')}",
        "1,2024-01-05,2": f"1,{iso(2024, 1, 5)},2",
    }
    assert dict(zip(cases, run(spark, list(cases)))) == cases
    parts = ["1.2.3.4.5", "0.4537960215852590", "4537960215852590.5", "x2024-01-05", "2024-01-05x", "2024-01-05-7", "1/02/29/2020", "2024-01-05Tea", "1-863-555-0950-7", "45379602158525904537960215852590"]
    assert run(spark, parts) == parts


def test_edges(spark):
    long = ("a." * 20000) + " x@" + "a." * 5000 + "com " + "1" * 30000 + " 1.2.3.4.5 v1.2.3.4x " + "4537960215852590 27.65.93.188 " * 200
    texts = [None, "", "no digits", long, "4537960215852590 " * 2]
    got = run(spark, texts)
    assert got[:3] == [None, "", "no digits"]
    assert got[3].startswith("a.a.") and "1.2.3.4.5 v1.2.3.4x" in got[3] and "4537960215852590" not in got[3] and "27.65.93.188" not in got[3]
    assert got[4].split() == [card("4537960215852590")] * 2


def test_clashing_columns_repeated_rows_empty_table(spark):
    df = spark.createDataFrame([(1, "ip 1.2.3.4", 9, "k"), (1, "ip 1.2.3.4", None, None)], "doc_id long, text string, n_replaced int, _new string")
    got = Z.pseudonymise(df, KEY)
    assert sorted(got.columns) == ["_new", "doc_id", "n_replaced", "text"]
    assert [(r.text, r.n_replaced) for r in got.collect()] == [(f"ip {ip('1.2.3.4')}", 1)] * 2
    assert Z.pseudonymise(df.limit(0), KEY).count() == 0


@pytest.mark.parametrize("needle", ["Python", "Arrow", "Pandas"])
def test_plan_is_native(spark, needle):
    plan = op10_feistel(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert needle not in plan


def test_query_leaves_no_value(spark):
    before = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    after = {r.doc_id: r for r in op10_feistel(spark, SF_SMALL).collect()}
    assert before.keys() == after.keys()
    changed = 0
    for i, t in before.items():
        for m in re.finditer(r"[a-z.0-9]+@mail\d\.example\.com|(?<![\d.])\d+\.\d+\.\d+\.\d+(?![\d.])|\+1 \(\d{3}\) \d{3}-\d{4}", t or ""):
            changed += 1
            assert m[0] not in after[i].text
        assert len(after[i].text) - len(t) in range(-60, 60)
        if not re.search(r"[\d@]", t):
            assert after[i].text == t
    assert changed
