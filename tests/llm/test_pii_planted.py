"""Planted entities of every kind, held against plain checks: found whole, typed, distinct, the same wherever they return."""

import random
import re


from voltarc.llm import pii


def luhn(digits):
    d = [int(c) for c in digits][::-1]
    return sum(x if k % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for k, x in enumerate(d)) % 10 == 0


def iban_ok(text):
    s = re.sub(r"\W", "", text)
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def iban(rng, country, n):
    account = "".join(rng.choice("0123456789") for _ in range(n))
    check = 98 - int("".join(str(int(c, 36)) for c in account + country + "00")) % 97
    return f"{country}{check:02}{account}"


def card(rng):
    head = "4" + "".join(rng.choice("0123456789") for _ in range(14))
    return next(head + c for c in "0123456789" if luhn(head + c))


def spaced(s, n=4):
    return " ".join(s[k : k + n] for k in range(0, len(s), n))


def planted(rng):
    """(kind, what is known, ways to write it)."""
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    word = lambda n: "".join(rng.choice("abcdefghijkmnop") for _ in range(n))
    out = []
    for _ in range(12):
        m = f"{word(4)}.{digits(2)}@{word(6)}.{rng.choice(['com', 'de'])}"
        out.append(("email", m, [m, m.upper()]))
        a, b, c = str(rng.randint(200, 999)), digits(3), digits(4)
        out.append(("phone", "1" + a + b + c, [f"+1 {a} {b} {c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+1{a}{b}{c}", f"+1 ({a}) {b}-{c}"]))
        x, y = "17" + digits(1), digits(8)
        out.append(("phone49", "49" + x + y, [f"+49{x}{y}", f"+49 {x} {y[:4]} {y[4:]}"]))
        n = card(rng)
        out.append(("card", n, [n, spaced(n), "-".join(n[k : k + 4] for k in range(0, 16, 4))]))
        i = iban(rng, "DE", 18)
        out.append(("iban", i, [i, spaced(i)]))
        out.append(("ssn", s := f"{digits(3)}-{digits(2)}-{digits(4)}", [s]))
        out.append(("ipv4", ip := ".".join(str(rng.randint(1, 250)) for _ in range(4)), [ip]))
        h = f"{rng.randint(4096, 65535):x}"
        out.append(("ipv6", f"2001:db8::{h}", [f"2001:db8::{h}", f"2001:0DB8:0:0:0:0:0:{h.upper()}"]))
        out.append(("hex", k := "".join(rng.choice("0123456789abcdef") for _ in range(40)) + "a1", [k]))
    return out


LOOKS = {
    "email": r"[A-Za-z]{4}\.\d\d\d*@[A-Za-z]{8,}\.(example|EXAMPLE)\.[A-Za-z]{3}", "phone": r"(\+1 ?)?\(?\d{3}\)?[ -]?\d{3}[ -]?\d{4}", "phone49": r"\+49 ?\d{3} ?\d{4} ?\d{4}", "card": r"\d{4}([ -]?)\d{4}\1\d{4}\1\d{4}",
    "iban": r"DE\d{2}( ?\d{4}){4} ?\d{2}", "ssn": r"\d{3}-\d\d-\d{4}", "ipv4": r"\d+\.\d+\.\d+\.\d+", "ipv6": r"[0-9a-fA-F]{4}:[0-9a-fA-F]{4}:[0-9a-fA-F:]+", "hex": r"[0-9a-f]{42}",
}


def known(kind, shown):
    plain = re.sub(r"\W", "", shown).lower()
    if kind == "phone":
        return plain if shown.startswith("+") else "1" + plain
    if kind == "email":
        return shown.lower()
    if kind == "ipv6":
        import ipaddress

        return str(ipaddress.ip_address(shown))
    return plain


def test_planted_entities(spark):
    rng = random.Random(21)
    things = planted(rng)
    filler = ["so it was", "then, again;", "nothing else!", "see 12 apples", "on 2024-01-01"]
    rows, where = [], []
    for k in range(400):
        parts, own = [rng.choice(filler)], []
        for _ in range(rng.randint(0, 5)):
            kind, what, ways = rng.choice(things)
            own.append((kind, what, shown := rng.choice(ways)))
            parts += [shown, rng.choice(filler)]
        rows.append((k, " ~ ".join(parts)))
        where.append((own, parts[0::2]))
    got = pii.with_surrogates(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()
    assert len(got) == 400
    made, real = {}, {(kind.removesuffix("49"), known(kind, w)) for kind, _, ways in things for w in ways}
    for r in got:
        own, rest = where[r.doc_id]
        parts = r.text.split(" ~ ")
        assert parts[0::2] == rest and r.n_entities == len(own)  # what is no entity stays, letter by letter
        for (kind, what, shown), new in zip(own, parts[1::2], strict=True):
            assert re.fullmatch(LOOKS[kind], new), (kind, shown, new)
            assert re.sub(r"\w", "", new) == re.sub(r"\w", "", shown) or kind in ("ipv6", "email")
            assert (kind.removesuffix("49"), known(kind, new)) not in real
            assert made.setdefault((kind, what), known(kind, new)) == known(kind, new), (kind, shown, new)
            if kind == "card":
                assert luhn(known(kind, new))
            if kind == "iban":
                assert iban_ok(new)
    for kind in LOOKS:
        own = [v for (k, _), v in made.items() if k == kind]
        assert len(own) > 8 and len(set(own)) == len(own)


def test_persons_by_title_gender_capitals_and_family(spark):
    rows = [
        (1, "Mr Giulio Rossi came. Rossi left, and Giulio too. Mrs Giulia Rossi stayed."),
        (2, "ANNA SCHMIDT and Anna Schmidt; MR SCHMIDT; Herr SCHMIDT; Jean DUPONT"),
        (3, "Frau Zwetlana Becker, Herr Zwetlana Becker"),
        (4, "MS WORD and DR NO are no persons, nor is THE ANNA or Anna alone"),
    ]
    got = {r.doc_id: r.text for r in pii.with_surrogates(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()}
    m = re.fullmatch(r"Mr (\w+ino) (\w+) came\. (\w+) left, and (\w+) too\. Mrs (\w+ina) (\w+) stayed\.", got[1])
    assert m and m[2] == m[3] == m[6] and m[4] == m[1] and not {"Giulio", "Rossi", "Giulia"} & set(m.groups())
    m = re.fullmatch(r"([A-Z]+) ([A-Z]+) and (\w+) (\w+); MR ([A-Z]+); Herr ([A-Z]+); (\w+) ([A-Z]+)", got[2])
    assert m and m[1] == m[3].upper() and m[2] == m[4].upper() == m[5] == m[6] != "SCHMIDT" and m[4].istitle() and m[8] != "DUPONT"
    assert m[3] in pii.GIVEN["latin-f"] and m[7] in pii.GIVEN["latin-m"]
    m = re.fullmatch(r"Frau (\w+ina) (\w+), Herr (\w+ino) (\w+)", got[3])
    assert m and m[2] == m[4]
    assert got[4] == rows[3][1]


def test_secrets_of_any_length(spark):
    long = "x7" * 400 + "/+" * 3000
    rows = [(1, f'password = "{long}" end'), (2, "key " + "ab12" * 50 + " end"), (3, f"token={'q9' * 700}; end"), (4, "ghp_" + "aB3" * 200)]
    got = {r.doc_id: r.text for r in pii.with_surrogates(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()}
    m = re.fullmatch(r'password = "(\S+)" end', got[1])
    assert m and len(m[1]) == len(long) and "x7x7" not in m[1] and "/+/+" not in m[1]
    assert re.fullmatch(r"key [0-9a-f]{200} end", got[2]) and "ab12ab12" not in got[2]
    assert re.fullmatch(r"token=\w{1400}; end", got[3]) and "q9q9" not in got[3]
    assert re.fullmatch(r"ghp_[A-Za-z0-9]{600}", got[4]) and "aB3aB3" not in got[4]


def test_a_format_that_its_entities_fill(spark):
    numbers = [f"+49 {k // 100:02} {k % 100:02}" for k in range(10_000)]
    df = spark.createDataFrame([(k, " , ".join(numbers[k * 100 : k * 100 + 100])) for k in range(100)], "doc_id long, text string")
    made = [x for r in pii.with_surrogates(df, "k").collect() for x in r.text.split(" , ")]
    assert len(made) == len(set(made)) == 10_000 and not set(made) & set(numbers)
    assert all(re.fullmatch(r"\+49 \d\d \d{2,9}", x) for x in made)


def test_domains_are_distinct_and_kept_together(spark, monkeypatch):
    rows = [(k, f"ann.x@host{k % 40}.org and bob.y@host{k % 40}.org") for k in range(80)]
    got = pii.with_surrogates(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()
    hosts = {}
    for r in got:
        a, b = (x.split("@")[1] for x in r.text.split(" and "))
        assert a == b == hosts.setdefault(r.doc_id % 40, a)
    assert len(set(hosts.values())) == 40


def test_own_key_and_clashing_columns(spark):
    rows = [(1, "at 10.1.2.3", 5, 0.5, "x", "y"), (2, None, 6, 0.5, "x", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_entities int, _found double, `a.b` string, row string")
    got = pii.mask_stage(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted((r["doc_id"], r["n_entities"], r["_found"], r["a.b"], r["row"]) for r in got.collect()) == [(1, 5, 0.5, "x", "y"), (2, 6, 0.5, "x", "y")]
    assert pii.key_of(spark) == pii.key_of(spark) and len(pii.key_of(spark)) == 64 and pii.key_of(spark, "mine") == "mine"
    assert pii.with_surrogates(docs).columns == ["doc_id", "text", "_found", "a.b", "row", "n_entities"]


def test_account_check_digits(spark):
    rng = random.Random(2)
    rows = [(iban(rng, "GB", 14),) for _ in range(20)] + [("GB82WEST12345698765432",)]
    df = spark.createDataFrame(rows, "t string")
    got = df.select(pii.mod97(pii.F.concat(pii.F.substr("t", pii.F.lit(5), pii.F.lit(99)), pii.F.substr("t", pii.F.lit(1), pii.F.lit(4)))).alias("r")).collect()
    assert {r.r for r in got} == {1}


