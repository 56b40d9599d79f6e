import datetime
import random
import re
import time

import pytest
import regex
from pyspark.sql import functions as F

from gridlake.llm import pii
from gridlake.llm.queries import QUERIES
from tests.llm.conftest import SF


def luhn(s):
    d = [int(c) for c in s][::-1]
    return sum(d[0::2] + [sum(divmod(2 * x, 10)) for x in d[1::2]]) % 10 == 0


def iban(s):
    s = s.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


VALID = [
    "jane.doe42@mail.example.com", "4111111111111111", "5500 0000 0000 0004", "+1 (988) 555-2485", "123-45-6789",
    "42.144.35.254", "1.43.173.185", "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32", "2024-02-29", "31.12.1999",
    "02/28/2020", "b44e15e09fd311c3cf3163b66d5a9875b883d8ce", "9233A8ECF7C5B09FE5949719B6B82BC439E9329B",
]
LEFT = ["4111111111111112", "000-45-6789", "DE88370400440532013000", "2023-02-29", "300.1.2.3", "version 2.0.", "12345", "a@b"]


def replaced(spark, texts, key="k"):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [(r.text, r.n_pseudonyms) for r in pii.pseudonymize(df, key).orderBy("doc_id").collect()]


def test_valid_values_keep_their_format_and_others_stay(spark):
    out = replaced(spark, VALID)
    for old, (new, n) in zip(VALID, out):
        assert n == 1 and new != old
        assert len(new) == len(old) or all(0 <= int(x) < 256 for x in new.split("."))
    new = dict(zip(VALID, (t for t, _ in out)))
    assert luhn(new["4111111111111111"]) and luhn(new["5500 0000 0000 0004"].replace(" ", ""))
    assert iban(new["DE89370400440532013000"]) and iban(new["GB82 WEST 1234 5698 7654 32"])
    # every pseudonym is again a value of its format
    assert [n for _, n in replaced(spark, list(new.values()), "other")] == [1] * len(VALID)
    assert replaced(spark, LEFT) == [(t, 0) for t in LEFT]


def test_equal_values_stay_linked_and_keys_differ(spark):
    a, b, c = replaced(spark, ["x 4111111111111111, y 4111-1111-1111-1111.", "4111111111111111", "4111111111111112"])
    assert a[1] == 2 and b[0] in a[0] and a[0].split("y ")[1].strip(".").replace("-", "") == b[0]
    assert replaced(spark, ["4111111111111111"], "other")[0][0] != b[0]


SWALLOWED = [  # (text, the values in it)
    ("card 4111111111111111 12/25", ["4111111111111111"]),
    ("4111 1111 1111 1111 123", ["4111 1111 1111 1111"]),
    ("no 12 4111 1111 1111 1111.", ["4111 1111 1111 1111"]),
    ("1234 4111 1111 1111 1111-7", ["4111 1111 1111 1111"]),
    ("4111111111111111 02/28/2020", ["4111111111111111", "02/28/2020"]),
    ("4111111111111111 123-45-6789", ["4111111111111111", "123-45-6789"]),
    ("4111111111111111 12ab", ["4111111111111111"]),
    ("4111111111111111 5500 0000 0000 0004 4111-1111-1111-1111", ["4111111111111111", "5500 0000 0000 0004", "4111-1111-1111-1111"]),
    ("BE68539007547034 EUR", ["BE68539007547034"]),
    ("ES9121000418450200051332 BIC", ["ES9121000418450200051332"]),
    ("AB12 DE89 3704 0044 0532 0130 00 x", ["DE89 3704 0044 0532 0130 00"]),
    ("BE68539007547034 DE89 3704 0044 0532 0130 00", ["BE68539007547034", "DE89 3704 0044 0532 0130 00"]),
    ("AB12 1234 5678 4111111111111111", ["4111111111111111"]),
]


def test_groups_next_to_a_value_do_not_hide_it(spark):
    """Each value has the pseudonym it has alone, the rest stays."""
    alone = sorted({v for _, values in SWALLOWED for v in values})
    new = dict(zip(alone, (t for t, _ in replaced(spark, alone))))
    want = []
    for text, values in SWALLOWED:
        for v in values:
            text = text.replace(v, new[v], 1)
        want.append((text, len(values)))
    assert replaced(spark, [t for t, _ in SWALLOWED]) == want


@pytest.mark.parametrize("radix", [(10, 10, 10), (898, 99, 9999), (256,) * 4, (5,), (189, 773)])
def test_the_network_is_a_permutation(spark, radix):
    df = spark.range(2000).select(F.array(*[
        F.pmod(F.xxhash64("id", F.lit(i)), F.lit(r)).alias("v") for i, r in enumerate(radix)
    ]).alias("v")).distinct()
    sizes = F.array(*[F.lit(r).cast("long") for r in radix])
    out = df.withColumn("w", pii.feistel(F.col("v"), sizes, "k", "t"))
    out = out.withColumn("back", pii.feistel(F.col("w"), sizes, "k", "t", inverse=True)).collect()
    assert all(r.v == r.back and all(0 <= x < s for x, s in zip(r.w, radix)) for r in out)
    assert len({tuple(r.w) for r in out}) == len(out)


def test_odd_rows(odd_docs, no_docs):
    rows = pii.pseudonymize(odd_docs, "k").collect()
    old = {r.doc_id: r.text for r in odd_docs.collect()}
    for r in rows:
        if r.doc_id == 8:
            assert r.n_pseudonyms == 2 and "4111111111111111" not in r.text and "2024-02-29" not in r.text
        else:
            assert (r.text, r.n_pseudonyms) == (old[r.doc_id], 0)
    assert pii.pseudonymize(no_docs, "k").count() == 0


def test_query_is_native_and_leaves_clean_texts(spark, docs_pd):
    out = QUERIES["op5_pii"](spark, SF)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    old = dict(zip(docs_pd.doc_id, docs_pd.text))
    rows = out.collect()
    assert len(rows) == len(old) and any(r.n_pseudonyms for r in rows)
    for r in rows:
        assert (r.text == old[r.doc_id]) == (r.n_pseudonyms == 0)


# -- a plain version: the same formats and searches, run over lists ------------


def valid(name, m):
    bare = re.sub("[^A-Za-z0-9]", "", m)
    if name == "card":
        return 13 <= len(bare) <= 19 and luhn(bare)
    if name == "iban":
        return bool(re.match("[A-Z]{2}[0-9]{2}", m)) and 12 <= len(bare) <= 35 and iban(m)
    if name == "date":
        for fmt, y in (("%Y-%m-%d", m[:4]), ("%d.%m.%Y", m[-4:]), ("%m/%d/%Y", m[-4:])):
            try:
                datetime.datetime.strptime(m, fmt)
                return 1700 <= int(y) < 2100
            except ValueError:
                pass
        return False
    return True


def groups_of(m, name):
    """Values among the whole groups of a match: from each group on, the longest."""
    groups, out, i = regex.split("(?=[ -])", m, flags=regex.V1), [], 0
    while i < len(groups):
        sign = groups[i][:1] if i else ""
        for j in range(min(i + 19, len(groups)), i, -1):
            text = "".join(groups[i:j])[len(sign):]
            if valid(name, text):
                out += [(sign, False), (text, True)]
                i = j
                break
        else:
            out.append((groups[i], False))
            i += 1
    return out


def plain(text):
    """The pieces of a text: (part, is a value)."""
    pieces = [(text, False)]
    for pattern in pii.PATTERNS:
        if pattern is not pii.PATTERNS[0] and not any(regex.search(pii.FORMATS[f], text) for f in ("card", "iban")):
            break
        out = []
        for part, done in pieces:
            if done:
                out.append((part, True))
                continue
            at = 0
            for m in regex.finditer(pattern, part, regex.ASCII):
                out.append((part[at : m.start()], False))
                at = m.end()
                name = next((f for f in ("email", "iban", *pii.FORMATS) if regex.fullmatch(pii.FORMATS[f], m.group(), regex.ASCII)), None)
                if name in ("card", "iban"):
                    out += groups_of(m.group(), name)
                else:
                    out.append((m.group(), name is not None and valid(name, m.group())))
            out.append((part[at:], False))
        pieces = []
        for part, done in out:  # neighbouring plain pieces are one
            if pieces and not done and not pieces[-1][1]:
                pieces[-1] = (pieces[-1][0] + part, False)
            else:
                pieces.append((part, done))
    return pieces


def against_plain(spark, texts):
    pieces = [plain(t) for t in texts]
    values = sorted({v for p in pieces for v, is_value in p if is_value})
    new = dict(zip(values, (t for t, _ in replaced(spark, values))))
    # a value whose pseudonym is itself does not count as one
    want = [("".join(new[v] if x else v for v, x in p), sum(x and new[v] != v for v, x in p)) for p in pieces]
    assert replaced(spark, texts) == want
    return len(values)


def test_random_texts_against_the_plain_version(spark):
    rng = random.Random(7)
    parts = [*VALID, *LEFT, "4111", "1111", "12", "7", "ab", "DE89", "3704", "0044", "x", "é", "\n", ",", ".", "(", "0", "2024-01-01"]
    texts = ["".join(rng.choice(parts) + rng.choice(["", " ", "-", " ", "  "]) for _ in range(rng.randint(1, 14))) for _ in range(400)]
    assert against_plain(spark, texts) > 100


def test_real_texts_against_the_plain_version(spark, docs_pd):
    assert against_plain(spark, [t or "" for t in docs_pd.text]) > 10


@pytest.mark.parametrize("sep", [" ", "-"])
def test_a_card_behind_any_number_of_groups_is_found(spark, sep):
    """Groups of digits that make no card by themselves, whatever their number."""
    texts = [sep.join(["10"] * n + ["4111", "1111", "1111", "1111"]) for n in (0, 19, 127, 128, 398, 399, 400, 401, 402, 1000)]
    against_plain(spark, texts)
    for text, n in replaced(spark, texts):
        assert n >= 1 and not text.endswith(sep.join(["4111", "1111", "1111", "1111"]))


def test_cost_is_linear_in_the_values_of_a_text(spark):
    def seconds(n):
        text = "".join(f"user{i}@mail{i % 10}.example.com, 4111 1111 1111 1111; " for i in range(n // 2))
        df = spark.createDataFrame([(1, text)], "doc_id long, text string")
        start = time.monotonic()
        assert pii.pseudonymize(df, "k").first().n_pseudonyms == n
        return time.monotonic() - start

    seconds(100)
    few, many = seconds(2_000), seconds(20_000)
    assert many < 20 * few + 5, (few, many)


def test_cost_is_linear_in_the_groups_of_a_run(spark):
    def seconds(n):
        df = spark.createDataFrame([(1, " ".join(["1234567"] * n))], "doc_id long, text string")
        start = time.monotonic()
        pii.pseudonymize(df, "k").first()
        return time.monotonic() - start

    seconds(100)
    few, many = seconds(1_000), seconds(6_000)
    assert many < 12 * few + 5, (few, many)
