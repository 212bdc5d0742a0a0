import re

from pyspark.sql import functions as F

from tidemark.llm import pii_surrogates

ROWS = [
    (1, "Write to ann.lee@corp.example.com or ANN.LEE@CORP.EXAMPLE.COM, call +1 (988) 555-2485 or 988-555-2485; 10.0.0.1, "
        "card 4041894974608795 and 4041-8949-7460-8795, not 4041894974608796."),
    (2, None), (3, ""), (4, "Mrs. Maria Jones met Mr Jones; Herr Müller; Г-жа Анна Иванова. SSN 123-45-6789 IBAN DE89 3704 0044 0532 0130 00"),
    (4, "call 988.555.2485"), (5, "42.144.35.254 a@b.co"), (6, "version 1.2.3.4.5, 3.14, 2024-01-02, id 12345678901234567890123"),
    (None, "call 988.555.2485"), (7, "w " * 50_000 + "ann.lee@corp.example.com"),
]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def replaced(make, key="k"):
    return [(r["doc_id"], r["text"], r["__mentions"]) for r in pii_surrogates.replace_entities(make(ROWS), key).collect()]


def test_types_formats_and_coreference(make):
    got = replaced(make)
    texts = {(i, len(t or "")): t for i, t, _ in got}
    first = next(t for i, t, _ in got if i == 1)
    mails = re.findall(r"[A-Za-z.]+@[A-Za-z.]+", first)
    assert len(mails) == 2 and mails[0].upper() == mails[1] and "ann" not in mails[0] and mails[0].endswith(".example.com")
    cards = re.findall(r"\b\d{16}\b", first)
    assert cards[1] == "4041894974608796" and cards[0] != "4041894974608795" and luhn(cards[0])
    dashed = re.search(r"\d{4}-\d{4}-\d{4}-\d{4}", first)[0]
    assert dashed.replace("-", "") == cards[0]
    call = re.search(r"\+1 \((\d{3})\) (\d{3}-\d{4}) or (\d{3}-\d{3}-\d{4})", first)
    assert f"{call[1]}-{call[2]}" == call[3] != "988-555-2485"
    assert {t for i, t, _ in got if i is None or (i == 4 and len(t) < 30)} == {"call " + call[3].replace("-", ".")}
    people = re.match(r"Mrs\. (\w+) (\w+) met Mr (\w+); Herr (\w+); Г-жа ([А-я]+) ([А-я]+)\. SSN \d{3}-\d{2}-\d{4} IBAN DE\d\d \d{4} \d{4} \d{4} \d{4} \d\d",
                      next(t for i, t, _ in got if i == 4 and len(t) > 30))
    assert people[2] == people[3] != "Jones" and people[1].endswith("na") and people[5].endswith("на") and people[4] != people[3]
    untouched = {i: t for i, t, n in got if n == 0}
    assert untouched == {2: None, 3: "", 6: ROWS[6][1]}
    long = next(t for i, t, _ in got if i == 7)
    assert long == "w " * 50_000 + mails[0] and len(got) == len(ROWS) and texts


def test_key_and_repeatability(make):
    order = lambda rows: sorted(rows, key=str)
    assert order(replaced(make)) == order(replaced(make)) != order(replaced(make, "other"))


def test_surrogates_are_distinct_and_no_real_entity(spark):
    # 3 digits: 1000 forms, 400 of them real, so draws collide often.
    entities = spark.range(100, 500).select(F.lit("ssn").alias("kind"), F.col("id").cast("string").alias("canon"))
    got = {r["canon"]: r["surrogate"] for r in pii_surrogates.surrogates(entities, "k").collect()}
    assert len(got) == len(set(got.values())) == 400 and not set(got) & set(got.values())


def test_no_room_left_gives_marks(spark):
    entities = spark.range(10).select(F.lit("ssn").alias("kind"), F.col("id").cast("string").alias("canon"))
    got = [r["surrogate"] for r in pii_surrogates.surrogates(entities, "k", rounds=3).collect()]
    assert len(set(got)) == 10 and all(s.startswith("[ssn:") for s in got)


def test_empty_table_columns_and_plan(make, capsys):
    docs = make([])
    out = pii_surrogates.replace_entities(docs, "k")
    assert out.count() == 0 and out.columns == [*docs.columns, "__mentions"]
    capsys.readouterr()
    pii_surrogates.replace_entities(make(ROWS), "k").explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_numbers_beside_each_other_are_no_card(make):
    rows = [(1, "2024-01-15 555-123-4567"), (2, "4711 555-123-4567"), (3, "123-45-6789 987-65-4322"), (9, "123-45-6789 987-65-4321"), (4, "4041894974608795 123"),
            (5, "4711 4712 47135 555 123 4567"), (6, "see 4041-8949-7460-8796."), (7, "2024-01-15 555-123-4567, a@b.co"), (8, "x 4711 555-123-4567")]
    got = {r["doc_id"]: (r["text"], r["__mentions"]) for r in pii_surrogates.replace_entities(make(rows), "k").collect()}
    phone = got[2][0][5:]
    assert re.fullmatch(r"\d{3}-\d{3}-\d{4}", phone) and phone != "555-123-4567"
    assert got[1] == (f"2024-01-15 {phone}", 1) and got[2] == (f"4711 {phone}", 1) and got[8] == (f"x 4711 {phone}", 1)
    first, second = got[3][0].split()
    assert got[3][1] == 2 and first != "123-45-6789" and second != "987-65-4322" and re.fullmatch(r"(\d{3}-\d\d-\d{4} ?){2}", got[3][0])
    # By chance this one has a right check digit: one card, its digits replaced all the same.
    assert luhn("123456789987654321") and got[9][1] == 1 and "123-45-6789" not in got[9][0] and "987-65-4321" not in got[9][0]
    assert got[4][1] == 1 and got[4][0].endswith(" 123") and luhn(got[4][0][:16]) and not got[4][0].startswith("4041894974608795")
    assert got[5][0].endswith(phone.replace("-", " ")), got[5]
    assert got[6] == (dict(rows)[6], 0)
    assert got[7][0].startswith(f"2024-01-15 {phone}, ") and got[7][1] == 2 and "a@b.co" not in got[7][0]


def texts(make, rows, key="k"):
    return {r["doc_id"]: r["text"] for r in pii_surrogates.replace_entities(make(rows), key).collect()}


def test_names_are_replaced_without_a_form_of_address_too(make):
    got = texts(make, [(1, "Dr. John Smith spoke. Later SMITH and John met Mr John Smith; Smithson stayed."), (2, "John Smith is not addressed here.")])
    first = re.match(r"Dr\. (\w+) (\w+) spoke\. Later SMITH and (\w+) met Mr (\w+) (\w+); Smithson stayed\.", got[1])
    assert first and first[1] == first[3] == first[4] != "John" and first[2] == first[5] != "Smith"
    assert got[2] == "John Smith is not addressed here."


def test_case_country_codes_private_addresses_and_account_check_digits(make):
    got = texts(make, [
        (1, "Mr. JOHN SMITH and Mr John Smith"), (2, "+1 212-555-0123 or 212-555-0123 or +44 212-555-0123"),
        (3, "10.0.0.1 192.168.7.9 127.0.0.1 8.8.8.8"), (4, "IBAN DE89370400440532013000 and GB82 WEST 1234 5698 7654 32"),
    ])
    loud = re.match(r"Mr\. (\w+) (\w+) and Mr (\w+) (\w+)", got[1])
    assert loud[1] == loud[3].upper() and loud[2] == loud[4].upper() and loud[3].istitle()
    one, plain, other = re.match(r"\+1 (\S+) or (\S+) or \+44 (\S+)$", got[2]).groups()
    assert one == plain != other and all(re.fullmatch(r"\d{3}-\d{3}-\d{4}", x) for x in (one, other)) and "212-555-0123" not in (one, other)
    ips = got[3].split()
    assert ips[0].startswith("10.") and ips[1].startswith("192.168.") and ips[2].startswith("127.") and ips[3] != "8.8.8.8"
    for account in re.findall(r"[A-Z]{2}\d\d(?: ?[A-Z0-9]{4})+(?: ?[A-Z0-9]{1,3})?(?![A-Z0-9])", got[4]):
        plain = account.replace(" ", "")
        assert int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1
    assert re.fullmatch(r"IBAN DE\d{20} and GB\d\d [A-Z]{4} \d{4} \d{4} \d{4} \d\d", got[4]) and "3704" not in got[4]


def test_clashing_columns_and_the_key_stay_out(make, capsys):
    docs = make([(1, "call 212-555-0123"), (2, "none")]).selectExpr("*", "1 AS `row`", "2 AS a", "3 AS __found", "4 AS __pieces", "5 AS `x.y`", "6 AS shown", "7 AS __a")
    out = pii_surrogates.replace_entities(docs, "it's a \\ secret")
    assert out.columns == [*docs.columns, "__mentions"]
    assert sorted((r["doc_id"], r["row"], r["__pieces"], r["x.y"], r["__mentions"]) for r in out.collect()) == [(1, 1, 4, 5, 1), (2, 1, 4, 5, 0)]
    capsys.readouterr()
    out.explain(True)
    assert "a \\ secret" not in capsys.readouterr().out


def test_mentions_equal_plain_python(spark):
    """Every text of the test data: the mentions are those of the patterns in Python's own engine."""
    import regex

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    wide, narrow = regex.compile(pii_surrogates.PATTERN), regex.compile(pii_surrogates.NARROW_PATTERN)
    kinds = {k: regex.compile(p) for k, p in pii_surrogates.PATTERNS.items()}

    def count(text):
        n, gap = 0, 0
        spans = [(m.start(), m.end()) for m in wide.finditer(text)]
        bad = [s for s in spans if regex.fullmatch(r"[0-9][0-9 -]+", text[s[0] : s[1]]) and len(regex.sub("[^0-9]", "", text[s[0] : s[1]])) >= 13
               and not luhn(regex.sub("[^0-9]", "", text[s[0] : s[1]]))]
        good = [s for s in spans if s not in bad] + [(len(text), len(text))]
        for start, end in good:
            if any(gap <= b[0] < start for b in bad):
                for m in narrow.finditer(text[gap:start]):
                    kind = next(k for k, p in kinds.items() if p.fullmatch(m[0]))
                    n += kind != "card" or luhn(regex.sub("[^0-9]", "", m[0]))
            n += start < len(text)
            gap = end
        return n

    got = pii_surrogates.replace_entities(docs, "k").select("doc_id", "__mentions").collect()
    want = {r["doc_id"]: count(r["text"] or "") for r in docs.collect()}
    assert {r["doc_id"]: r["__mentions"] for r in got} == want and sum(want.values()) > 50
