"""Licences, PII, mixing, decontamination, chats and the pipeline, against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shardwright.llm import chat, decontaminate, licenses, mixing, pii

MIT = "\n".join(["MIT License", "", "Copyright (c) 2020 Someone", "", *[licenses.SENTENCES[k][0] for k in ("mit-grant", "mit-notice", "mit-warranty", "mit-liability")]])
WRAPPED = re.sub(r"(.{60}\S*) ", r"\1\n", licenses.SENTENCES["apache-grant"][0] + "\n" + licenses.SENTENCES["apache-copy"][0] + "\n\n" + licenses.SENTENCES["apache-warranty"][0] + " " + licenses.SENTENCES["apache-terms"][0])


def test_licences(spark):
    texts = [None, "", "nothing", "Some prose. Licensed under CC BY-NC 4.0.\nMore of it", MIT, WRAPPED, "RELEASED UNDER the   mit license", "All rights reserved. All rights reserved.", "x " * 50_000 + "\nReleased under the MIT License.", "not released under the MIT License."]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(3, texts[3], "x"), (None, texts[3], "x")], "doc_id long, text string, licence string")
    got = sorted(map(tuple, licenses.scan(df).collect()), key=repr)
    names = [(g[0], g[1], g[4]) for g in got]
    reserved = "LicenseRef-all-rights-reserved"
    want = [(3, "CC-BY-NC-4.0", 1), (3, "CC-BY-NC-4.0", 1), (None, "CC-BY-NC-4.0", 1), (4, "MIT", 5), (5, "Apache-2.0", 4), (6, "MIT", 1), (7, reserved, 1), (7, reserved, 1), (8, "MIT", 1)]
    assert sorted(names, key=repr) == sorted(want, key=repr)
    spans = {(i, t[a:b]) for i, _, a, b, _ in got if i is not None for t in [texts[i]]}
    assert (3, "Licensed under CC BY-NC 4.0.") in spans and (8, "Released under the MIT License.") in spans


def test_wrapped_licences_and_comment_headers(spark):
    import textwrap

    own = lambda *keys: "\n\n".join(textwrap.fill(" ".join(licenses.SENTENCES[k][0] for k in part), 78) for part in keys)
    mit = "MIT License\n\nCopyright (c) 2020 Someone\n\n" + own(["mit-grant"], ["mit-notice"], ["mit-warranty", "mit-liability"])
    bsd = own(["bsd-use"]) + "\n\n1. " + own(["bsd-source"]) + "\n\n2. " + own(["bsd-binary"]) + "\n\n"
    gpl = own(["gpl3-grant"], ["gpl-warranty", "gpl-details"])
    marked = lambda text, mark: "\n".join(f"{mark} {line}" for line in text.split("\n"))
    texts = [mit, bsd + own(["bsd-warranty"]), bsd + "3. " + own(["bsd-endorse"], ["bsd-warranty"]), gpl, marked(mit, "#"), "/*\n" + marked(mit, " *") + "\n */\nint x;", marked(gpl, "#"), "/*\n" + marked(gpl, " *") + "\n */", marked(mit, "//")]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted((r["doc_id"], r["licence"], r["n_sentences"]) for r in licenses.scan(df).collect())
    assert got == [(0, "MIT", 5), (1, "BSD-2-Clause", 4), (2, "BSD-3-Clause", 5), (3, "GPL-3.0-or-later", 3), (4, "MIT", 5), (5, "MIT", 5), (6, "GPL-3.0-or-later", 3), (7, "GPL-3.0-or-later", 3), (8, "MIT", 5)]


def test_every_rule_is_found_wrapped_and_commented(spark):
    import textwrap

    cases = []
    for licence, keys in licenses.RULES:
        for k in range(max(len(licenses.SENTENCES[key]) for key in keys)):
            body = "\n".join(textwrap.fill(licenses.SENTENCES[key][min(k, len(licenses.SENTENCES[key]) - 1)], 72, break_long_words=False, break_on_hyphens=False) for key in keys)
            cases += [(licence, mark + body.replace("\n", "\n" + mark)) for mark in ("", "# ", "// ", " * ")]
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(cases)], "doc_id long, text string")
    got = {}
    for r in licenses.scan(df).collect():
        got.setdefault(r["doc_id"], []).append(r["licence"])
    assert {i: got.get(i) for i in range(len(cases))} == {i: [name] for i, (name, _) in enumerate(cases)}


def test_unknown_sentences_count_however_long(spark):
    first, *rest = [licenses.SENTENCES[k][0] for k in ("mit-grant", "mit-notice", "mit-warranty", "mit-liability")]
    texts = [" ".join([first, *[f"{'word ' * n}end."] * times, *rest]) for n, times in ((2, 5), (3000, 5), (2, 2), (3000, 2))]
    got = {r["doc_id"] for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect() if r["n_sentences"] == 4}
    assert got == {2, 3}


def test_rules_match_as_brute_force_does():
    rng = random.Random(0)
    rules = [("A", ("a",)), ("AB", ("a", "b")), ("ABC", ("a", "b", "c")), ("CB", ("c", "b")), ("A2", ("a",))]
    for _ in range(300):
        found, n = [], 0
        for i in range(rng.randint(0, 9)):
            n += rng.choice([1, 1, 2, 4])
            found.append((n, 10 * i, 10 * i + 5, rng.choice("abcd")))
        want, i = [], 0
        while i < len(found):
            fits = [(name, k) for name, k in rules if [f[3] for f in found[i : i + len(k)]] == list(k) and all(found[j + 1][0] - found[j][0] <= 3 for j in range(i, i + len(k) - 1))]
            if fits:
                name, k = max(fits, key=lambda f: len(f[1]))
                want.append((name, found[i][1], found[i + len(k) - 1][2], len(k)))
                i += len(k)
            else:
                i += 1
        assert licenses.match_rules(found, rules, gap=2) == want


PEOPLE = [
    "Call +1 (743) 555-3824 or 743-555-3824, mail bosbt.42@mail8.example.com", "BOSBT.42@MAIL8.EXAMPLE.COM wrote; card 4111111111111111 and 4111-1111-1111-1111", "Mr. John Smith met Mrs Smith. John Smith left; JOHN SMITH? Frau Julia Weber", "host 10.2.3.4 and 8.8.8.8, ssn 123-45-6789",
    "Госпожа Анна Петрова и Иван Петров", "no entity 12 here", "", None, "word " * 30_000 + "a@b.co", "+1 (743) 555-3824", "x" * 100_000,
]


def test_surrogates_are_consistent_and_distinct(spark):
    df = spark.createDataFrame([(i, t, 7) for i, t in enumerate(PEOPLE)] + [(0, PEOPLE[0], 7)], "doc_id long, text string, n_entities int")
    got = pii.replace_pii(df, "k", ["doc_id", "text"]).collect()
    assert sorted(r["doc_id"] for r in got) == sorted([*range(len(PEOPLE)), 0])
    by = {r["doc_id"]: r["text"] for r in got}
    assert by[5] == PEOPLE[5] and by[6] == "" and by[7] is None and by[10] == PEOPLE[10]
    assert len({r["text"] for r in got if r["doc_id"] == 0}) == 1
    for text in by.values():
        assert not re.search(r"555-3824|bosbt|4111111111111111|John|Weber|8\.8\.8\.8|123-45-6789|Петров\b", text or "", re.I)
    phone = re.match(r"Call (\+1 \(\d{3}\) \d{3}-\d{4}) or (\d{3}-\d{3}-\d{4}), mail ([a-z]{5}\.\d\d@[a-z]{4}\d\.[a-z]{7}\.com)$", by[0])
    assert phone and by[9] == phone[1]
    assert by[1].startswith(phone[3].upper())
    card, grouped = re.search(r"card (\d{16}) and ([\d-]+)", by[1]).groups()
    assert grouped.replace("-", "") == card and card[0] == "4"
    doubled = [int(c) * (2 - i % 2) for i, c in enumerate(card)]
    assert sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0
    john = re.match(r"Mr\. (\w+) (\w+) met Mrs (\w+)\. (\w+) (\w+) left; (\w+) (\w+)\? Frau (\w+) (\w+)$", by[2]).groups()
    assert john[1] == john[2] == john[4] and john[0] == john[3] and (john[5], john[6]) == (john[0].upper(), john[1].upper()) and john[8] != john[1]
    assert john[0].lower() in pii.GIVEN["m", "latin"] and john[7].lower() in pii.GIVEN["f", "latin"]
    assert re.match(r"host 10\.\d+\.\d+\.\d+ and (?!10\.)\d+\.\d+\.\d+\.\d+, ssn \d{3}-\d{2}-\d{4}$", by[3])
    she = re.match(r"Госпожа (\w+) (\w+) и (\w+) (\w+)$", by[4]).groups()
    assert she[0].lower() in pii.GIVEN["f", "cyrillic"] and she[1].endswith("а") and she[2].lower() in pii.GIVEN["m", "cyrillic"]


def test_collisions_are_drawn_again(spark):
    names = [f"name{i}" for i in range(60)]  # more than there are listed given names
    ents = spark.createDataFrame([("given:latin", n, "given:latin:m") for n in [*names, *pii.GIVEN["m", "latin"]]] + [("phone", f"1{i:03}", "phone") for i in range(300)], "kind string, canon string, type string")
    got = pii.assign(ents, "k").collect()
    assert len(got) == 60 + len(pii.GIVEN["m", "latin"]) + 300
    for space in ("given", "phone"):
        own = [r for r in got if r["kind"].startswith(space)]
        assert len({r["surrogate"] for r in own}) == len(own) and not {r["surrogate"] for r in own} & {r["canon"] for r in own}


def test_one_entity_has_one_surrogate_in_any_notation(spark):
    texts = [
        "Mr. Taro Sato", "Dr. Taro Sato", "Miss Taro Sato", "743-555-3824", "+1 743 555 3824", "(743) 555-3824", "Wei Zhang and Fatima Khan met Aisha Bello", "name is Zorblax Quux.", "pay DE89 3704 0044 0532 0130 00 or DE89370400440532013000 now",
        "at 2001:db8::8a2e:370:7334 or 2001:0DB8:0:0:0:8a2e:0370:7334", "link fe80::1 up", "at 12:30:45 use std::string in a::b", "Ms. Robin Gray", "Ms. Robin Hale", "Mr. Robin Gray",
    ]
    got = {r["doc_id"]: r["text"] for r in pii.replace_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "k").collect()}
    assert {got[i].split(" ", 1)[1] for i in range(3)} == {got[0][4:]} != {"Taro Sato"} and [got[i].split(" ")[0] for i in range(3)] == ["Mr.", "Dr.", "Miss"]
    digits = [re.sub(r"\D", "", got[i])[-10:] for i in (3, 4, 5)]
    assert len(set(digits)) == 1 and digits[0][0] == "7" and digits[0] != "7435553824" and got[4].startswith("+1 7") and re.fullmatch(r"\(\d{3}\) \d{3}-\d{4}", got[5])
    assert not re.search("Wei|Zhang|Fatima|Khan|Aisha|Bello|Zorblax|Quux", got[6] + got[7]) and got[7].startswith("name is ")
    grouped, plain = re.fullmatch(r"pay (DE\d\d(?: [A-Z0-9]{4}){4} \d\d) or (DE\d{20}) now", got[8]).groups()
    assert grouped.replace(" ", "") == plain != "DE89370400440532013000" and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1
    one, two = re.fullmatch(r"at (\S+) or (\S+)", got[9]).groups()
    assert one == two and one.startswith("2001:db8:") and got[10].startswith("link fe80:") and got[11] == texts[11]
    she = {got[i].split()[1].lower() for i in (12, 13, 14)}
    assert len(she) == 1 and she < set(pii.GIVEN["f", "latin"])


def test_entities_are_those_that_brute_force_finds(spark):
    """Whatever lies between entities stays, and texts are alike up to a one-to-one exchange of entities."""
    import regex

    rng, whole = random.Random(4), regex.compile(pii.ENTITY)
    bits = ["a.b@c9.org", "x@y", "10.0.0.1", "256.1.1.1", "123-45-6789", "4111 1111 1111 1111", "+49 30 1234567", "743.555.3824", "Mr Lee", "Dr. Anna May", "Ivan Grey", "IVAN GREY", "Ivan", "fe80::a1", "1:2:3", "GB29NWBK60161331926819", "Иван Белов", "the", "Mrs", "end.", "a@b.c.d.e.fg", "\n", "é"]
    texts = [" ".join(rng.choices(bits, k=rng.randint(1, 12))) for _ in range(120)]
    rows = pii.replace_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "k").collect()
    there, back = {}, {}
    for r in rows:
        old = texts[r["doc_id"]]
        assert r["n_entities"] == len(whole.findall(old))
        gaps = whole.split(old)
        found = regex.fullmatch("(.+)".join(map(regex.escape, gaps)), r["text"], regex.S)
        assert found
        if len(gaps) == 2:
            there.setdefault(whole.search(old)[0], set()).add(found[1])
            back.setdefault(found[1], set()).add(whole.search(old)[0])
    assert there and all(len(v) == 1 for v in [*there.values(), *back.values()])


@pytest.mark.parametrize("text", ["a@" + "x." * 60_000 + "com", "a@" + "x." * 3000 + "com", "a@b." * 50_000, "1." * 100_000, "+1 " * 100_000, "A" * 500_000, "Mr " * 100_000, "1234 " * 100_000, "a:" * 200_000, "DE12" * 100_000, "a" * 1_000_000 + "@" + "b" * 1_000_000 + ".com"])
def test_long_texts_that_almost_fit(spark, text):
    got = pii.replace_pii(spark.createDataFrame([(1, text)], "doc_id long, text string"), "k").first()
    assert got["text"] == text or got["n_entities"] > 0


def test_surrogates_keep_columns_of_any_name(spark):
    names = "_t _s t m ms matches text_key surrogates surrogates_n pos kind canon space".split()
    df = spark.createDataFrame([(1, "a@b.org", *names), (2, "none", *names)], "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    got = pii.replace_pii(df, "k")
    assert got.columns == [*df.columns, "n_entities"] and sorted(r["n_entities"] for r in got.collect()) == [0, 1]
    assert all([r[n] for n in names] == names for r in got.collect())


def test_replacing_nothing(spark):
    assert pii.replace_pii(spark.createDataFrame([], "doc_id long, text string"), "k").count() == 0


def test_tokens_are_counted_as_split_does(spark):
    rng = random.Random(1)
    texts = [None, "", " ", "a", " a\tb\x0bc ", "é ü x\x85y", "x" * 300_000, " \n" * 100_000] + ["".join(rng.choices("aB \n\tü", k=rng.randint(0, 30))) for _ in range(50)]
    texts += ["\n| a |", "a\n- b", "a\n* b", "AB cd", "AB CD e", "ab cd", "wide " * 100, "ÄÖÜ" * 9]

    def kind(t):
        raw = t.encode()
        return "table" if "\n| " in t else "list" if "\n- " in t or "\n* " in t else "loud" if 2 * sum(65 <= c < 91 for c in raw) > len(raw) else "brief" if len(raw) < 500 else "prose"

    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, text string")
    got = {r["i"]: tuple(r["m"]) for r in df.select("i", mixing.measured("text").alias("m")).collect()}
    assert got == {i: (len((t or "").encode().split()), kind(t or "")) for i, t in enumerate(texts)}


def test_raking_that_does_not_settle_raises():
    cells = {(s, l, "t"): 100.0 for s in "ab" for l in "xy"}
    goals = {"source": {"a": 0.9, "b": 0.1}, "lang": {"x": 0.5, "y": 0.5}, "topic": {"t": 1.0}}
    with pytest.raises(RuntimeError, match="settle"):
        mixing.rake(cells, goals, 0.3, sweeps=1)
    assert mixing.rake(cells, goals, 0.3)


def test_mixing_keeps_columns_of_any_name(spark):
    names = "tokens class_source class_lang class_topic key_source key_lang key_topic p_keep _p _s _l _t _tokens _form".split()
    df = spark.createDataFrame([(i, "some words here", "s", "en", *range(len(names))) for i in range(50)], "doc_id long, text string, source string, lang string, " + ", ".join(f"{n} long" for n in names))
    got = mixing.mix(df)
    assert got.columns == [*df.columns, "keep_probability", "mix_weight", "n_tokens"]
    assert all([r[n] for n in names] == list(range(len(names))) for r in got.collect()) and got.count() > 0


def test_raking_meets_its_targets():
    rng = np.random.default_rng(0)
    cells = {(s, l, t): float(rng.integers(50, 500)) for s in "abc" for l in "xy" for t in "pq"}
    goals = {"source": {"a": 0.3, "b": 0.3, "c": 0.4}, "lang": {"x": 0.5, "y": 0.5}, "topic": {"p": 0.6, "q": 0.4}}
    shares = mixing.rake(cells, goals, 0.3)
    assert all(0 <= p <= 1 for p in shares.values())
    assert abs(sum(cells[k] * p for k, p in shares.items()) - 0.3 * sum(cells.values())) < 1e-3
    for d, name in enumerate(mixing.DIMENSIONS):
        for k, share in mixing.expected(cells, shares, d).items():
            assert abs(share - goals[name][k]) < 1e-4
    assert mixing.rake({}, goals, 0.5) == {} and set(mixing.rake(cells, goals, 1.0).values()) == {1.0}


def test_mixing_keeps_calibrated_documents(spark):
    rows = [(i, "word " * (i % 7), f"s{i % 3}", "en" if i % 4 else None, 5.0) for i in range(3000)] + [(None, None, None, None, 1.0), (1, "word ", "s1", "en", 5.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, mix_weight double")
    got = mixing.mix(df).collect()
    assert all(r["text"] for r in got) and sum(r["n_tokens"] for r in got) / sum(len((r[1] or "").split()) for r in rows) == pytest.approx(0.5, abs=0.05)
    assert sum(r["mix_weight"] * r["n_tokens"] for r in got) == pytest.approx(sum(len((r[1] or "").split()) for r in rows), rel=0.08)
    assert sorted(map(repr, got)) == sorted(map(repr, mixing.mix(df.repartition(7)).collect()))
    assert sum(r["doc_id"] == 1 for r in got) in (0, 2)
    assert mixing.mix(df.limit(0)).count() == 0


def test_every_source_and_language_has_its_target(spark):
    rows = [(i, "word " * (40 if i % 700 < 10 else 10), f"s{i % 700}", f"l{i % 340}" if i % 5 else None) for i in range(14_000)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string, lang string"), fraction=0.3).collect()
    whole = sum(len(r[1].split()) for r in rows)
    part = {s: sum(len(r[1].split()) for r in rows if r[2] == s) / whole for s in ("s3", "s600")}
    scale = sum((part["s3"] if k < 10 else part["s600"]) ** 0.5 for k in range(700))
    for named, own in (({f"s{k}" for k in range(10)}, 10 * part["s3"] ** 0.5 / scale), ({f"s{k}" for k in range(500, 700)}, 200 * part["s600"] ** 0.5 / scale)):
        assert sum(r["n_tokens"] for r in got if r["source"] in named) / sum(r["n_tokens"] for r in got) == pytest.approx(own, rel=0.15)
    expected = sum(r["mix_weight"] * r["n_tokens"] for r in got)
    assert expected == pytest.approx(whole, rel=0.1)


BENCH = [(1, "If Alice walks 12 km in 3 hours and then rests, how far does she walk in 9 hours at that pace?"), (2, "Plain words without any slot that go on for a while here"), (3, "too short here"), (4, None), (None, "Plain words without any slot that go on for a while here"), (5, "Plain words without any slot that go on for a while here")]
DOCS = [
    (0, "before it. " + BENCH[0][1] + " after"), (1, "so: If Bob walks 15 km in 4 hours and then rests, how far does she walk in 8 hours at that pace?"), (2, "PLAIN words without, any slot that go on FOR a while here!"), (3, "If Alice walks 12 km in 3 hours and then rests, how far"), (4, "clean text that says nothing of the kind at all, ever"),
    (5, None), (6, ""), (7, "x " * 40_000 + BENCH[1][1]), (8, "too short here"), (0, "before it. " + BENCH[0][1] + " after"), (None, BENCH[1][1]), (9, "If Bob walks 15 km in 15 hours and then rests, how far does she walk in 9 hours at that pace?"),
]


def test_benchmark_passages_are_found(spark):
    docs, bench = spark.createDataFrame([(*r, 1) for r in DOCS], "doc_id long, text string, item_id int"), spark.createDataFrame(BENCH, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["kind"]) for r in decontaminate.contaminated(docs, bench).collect()}
    plain = {(d, i, "exact") for d in (2, 7, None) for i in (2, 5)}
    assert got - {(9, 1, "reparameterised")} == plain | {(0, 1, "exact"), (1, 1, "reparameterised"), (3, 1, "exact")}
    assert sorted((r["doc_id"] for r in decontaminate.drop_contaminated(docs, bench).collect()), key=repr)[:4] == [4, 5, 6, 8]
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0
    split = decontaminate.contaminated(docs, bench, block_windows=3)
    assert {(r["doc_id"], r["item_id"], r["kind"]) for r in split.collect()} == got


def test_edited_and_redrawn_passages_are_found():
    long = "A farmer sells 60 eggs every single week to people of the town near the river. Later the farmer keeps the other half of what is left and again sells 60 eggs to everyone who asks for them"
    short = "the two boxes on the table weigh 2 kg and 3 kg so how much do both of them weigh"
    index = decontaminate.Index(8, 5)
    for i, t in enumerate((long, short)):
        index.add(i, t.encode())
    found = lambda t: {(p[0], p[1], p[3]) for p in decontaminate.passages(t.encode(), index.sealed(), decontaminate.Vocabulary())}
    assert found(long) == {(0, "exact", len(long.split()))}
    assert found(long[::-1].replace("06", "08", 1)[::-1]) == {(0, "reparameterised", 34)}
    longer = long + " and then the farmer sells 60 eggs to all other people who come by later on that day"
    index.add(2, longer.encode())
    assert (2, "exact", len(longer.split()) - 1) in found(longer.replace("again sells 60", "again sells 80"))
    assert found(short.replace("2 kg", "5 kg").replace("3 kg", "5 kg")) == {(1, "reparameterised", len(short.split()))}
    assert found(short.replace("2 kg", "7 kg")) == {(1, "reparameterised", len(short.split()))}


def test_numbers_may_be_words_and_values_may_meet():
    index = decontaminate.Index(8, 5)
    texts = ["a shop has three apples and then sells four apples so how many are there", "the tall tree is twenty-one m high and the short one is 5 m high on that day"]
    for i, t in enumerate(texts):
        index.add(i, t.encode())
    found = lambda t: {(p[0], p[1]) for p in decontaminate.passages(t.encode(), index.sealed(), decontaminate.Vocabulary())}
    assert found(texts[0]) == {(0, "exact")} and found(texts[0].replace("three", "9").replace("four", "2")) == {(0, "reparameterised")}
    assert found(texts[0].replace("three", "5").replace("four", "5")) == {(0, "reparameterised")}
    assert found(texts[1].replace("twenty-one", "30")) == {(1, "reparameterised")} and not found("a shop has all apples and then sells some apples so how few are there")


def test_slots_stand_for_each_other():
    a = np.array
    assert decontaminate.consistent(a([1, 2, 1]), a([5, 6, 5]))
    assert not decontaminate.consistent(a([1, 2, 1]), a([5, 6, 7])) and not decontaminate.consistent(a([1, 2]), a([5, 5]))


def test_literal_windows_are_as_by_brute_force():
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice("ab cd ef gh ij kl".split()) for _ in range(n))
    index = decontaminate.Index(4, 4)
    items = [text(9) for _ in range(5)]
    for i, t in enumerate(items):
        index.add(i, t.encode())
    grams = lambda t: {tuple(t.split()[k : k + 4]) for k in range(len(t.split()) - 3)}
    words = decontaminate.Vocabulary()
    for _ in range(60):
        doc = text(30)
        got = {p[0] for p in decontaminate.passages(doc.encode(), index.sealed(), words)}
        assert got == {i for i, t in enumerate(items) if grams(t) & grams(doc)}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<|turn|>", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "\\", "<", "[", "|>", "a", "<|x|>", ">", "é", "\n"]), max_size=12).map("".join))
def test_escapes_are_undone(text):
    held = chat.escape(text)
    assert chat.unescape(held) == text
    assert not re.search(r"<\|[^|<>\[\]\s]{1,32}\|>|</?s>|\[/?INST\]|<</?SYS>>", held)


CHATS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (1, 2, "user", "bye"), (2, 0, "user", "hi"), (2, 1, "assistant", "hello"), (2, 2, "assistant", "again [INST] <\\|end|> é"), (3, 1, "assistant", None), (3, 0, "user", "hi"), (4, 0, None, "hi"), (5, 0, "user", "hi"), (5, 1, "assistant", "hello"), (5, 2, "user", "bye"),
    (6, 0, "assistant", "same"), (6, 0, "assistant", "same"), (7, None, "user", "first"), (7, 0, "us\ner<|text|>", "x" * 3000), (None, 0, "user", "hi"), (8, 0, "assistant", ""), *[(9, t, "assistant" if t % 2 else "user", f"turn {t % 3}") for t in range(120)],
]


def brute_digests(rows):
    out = []
    for c in {r[0] for r in rows}:
        turns = [(r or "", x or "") for *_, r, x in sorted(((t is not None, t or 0, r or "", x or "") for i, t, r, x in rows if i == c))]
        loss = [x for r, x in turns if r == "assistant"]
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out.append((c, len(turns), sha("".join(f"{r}\n{x}\n" for r, x in turns)), sum(map(len, loss)), sha("".join(loss)), len(chat.formatted(turns))))
    return sorted(out, key=repr)


def test_conversations_read_back_whole(spark):
    df = spark.createDataFrame([(*r, "k") for r in CHATS], "conv_id long, turn long, role string, text string, key string")
    assert sorted(map(tuple, chat.digests(df).collect()), key=repr) == brute_digests(CHATS)
    assert chat.digests(df.limit(0)).count() == 0


def test_trees_share_their_beginnings(spark):
    df = spark.createDataFrame([r for r in CHATS if r[0] in (1, 2, 3, 5)], "conv_id long, turn long, role string, text string")
    packed, members = chat.format_conversations(df)
    (row,) = packed.coalesce(1).collect() if packed.count() == 1 else (packed.first(),)
    keys = {r["conv_id"]: r["key"] for r in members.collect()}
    assert keys[1] == keys[5] != keys[2]
    starts, ends, parents = row["node_start"], row["node_end"], row["parent"]
    if len(row["leaf_key"]) == 3:
        assert len(starts) == 5 and parents.count(-1) == 1  # hi, hello, bye, again, (empty)
    for n, p in enumerate(parents):
        assert p < n and row["position_ids"][starts[n]] == (row["position_ids"][ends[p] - 1] + 1 if p >= 0 else 0)
        seen = {t for a in row["attention"][n] for t in range(a["first"], a["last"])}
        path, k = set(), n
        while k >= 0:
            path |= set(range(starts[k], ends[k]))
            k = parents[k]
        assert seen == path


def test_any_number_of_shared_turns_is_emitted_once(spark):
    rows = [(c, t, "user", f"shared {t}") for c in range(12) for t in range(65)] + [(c, 65 + t, "user", f"{c // 4} end {t} {c if t == 4 else ''}") for c in range(12) for t in range(5)]
    packed, _ = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    codec = chat.Codec(open(chat.TOKENIZER, "rb").read())
    distinct = {tuple(sorted((t, x) for i, t, _, x in rows if i == c and t <= last)) for c in range(12) for last in range(70)}
    convs = chat.conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).orderBy("path").collect()
    packer = chat.Packer(codec, "p", 1 << 30)
    for r in convs:
        assert not list(packer.add(r["key"], [(t["role"], t["text"]) for t in r["turns"]]))
    assert len(packer.pack()["parent"]) == len(distinct) == 65 + 3 * 4 + 12
    assert sum(len(r["leaf_key"]) for r in packed.collect()) == 12


def test_packs_are_bounded_and_whole():
    codec = chat.Codec(open(chat.TOKENIZER, "rb").read())
    packer, out = chat.Packer(codec, "p", 60), []
    for i in range(20):
        out += packer.add(str(i), [("user", "start here"), ("assistant", f"answer {i // 4}"), ("user", f"end {i}")])
    out.append(packer.pack())
    assert sum((p["leaf_key"] for p in out), []) == [str(i) for i in range(20)] and len(out) > 1 and max(len(p["token_ids"]) for p in out) <= 60


def test_the_pipeline(spark, tmp_path):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    rng = random.Random(5)
    words = {"xx": "ra lo mi ta ke su no".split(), "yy": "zug bwr qik vxe jhy ploz".split()}
    prose = lambda lang, n: " ".join("".join(rng.choices(words[lang], k=3)) for _ in range(n))
    bench = [(1, prose("xx", 20))]
    docs = [(i, prose("xx" if i % 3 else "yy", 60), "xx" if i % 3 else "yy", f"s{i % 4}") for i in range(90)]
    docs += [(100, docs[0][1], "yy", "s0"), (101, docs[1][1].replace(" ", "  "), "xx", "s1"), (102, " ".join([*docs[2][1].split()[:-1], "odd"]), "xx", "s2"), (103, "12 34", "xx", "s1"), (104, None, None, "s1"), (105, prose("xx", 20) + " " + bench[0][1], "xx", "s1"), (106, prose("xx", 20) + " password=abcdef123", None, "s2")]
    spark.createDataFrame([(*d, len(d[1] or ""), 1.0, "x") for d in docs], "doc_id long, text string, lang string, source string, n_chars long, score double, node string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    at, held = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        columns = at.columns
        out = stage(spark, at, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        at = spark.read.parquet(f"{tmp_path}/{name}")
        held[name] = {r["doc_id"]: r for r in at.collect()}
        assert name == "mixing" or at.columns == columns
    everything = set(range(90)) | set(range(100, 107))
    assert set(held["language_id"]) == everything - {103, 104} and held["language_id"][106]["lang"] == "xx"
    assert set(held["ngram_join"]) == everything - {100, 101, 102, 103, 104}
    assert set(held["decontamination"]) == set(held["ngram_join"]) - {105}
    assert set(held["secret_scan"]) == set(held["decontamination"])
    assert held["secret_scan"][106]["text"].endswith(" [SECRET]") and held["secret_scan"][106]["n_chars"] == len(held["secret_scan"][106]["text"])
    assert all(held["secret_scan"][i]["text"] == held["decontamination"][i]["text"] for i in held["secret_scan"] if i != 106)
    assert 0 < len(held["mixing"]) < len(held["secret_scan"])
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(held["mixing"])
