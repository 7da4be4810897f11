"""PII surrogates, with DataFrame functions only.

E-mail addresses, phone, card, account (IBAN) and social-security numbers, IPv4 and IPv6 addresses and
names of persons are detected by pattern.  Every distinct entity of the corpus gets one surrogate of its
kind, drawn with a keyed hash: the same entity has the same surrogate everywhere (a phone number in two
notations, with or without the country code 1; an IPv6 address however shortened; a given name under any
title; a family name with or without its given name), different entities have different ones, and no
surrogate is an entity of the corpus.  Draws that collide, with each other or with an entity, are drawn
again in rounds of joins over the table of distinct entities.

What a surrogate keeps: an e-mail address its shape, separators and top-level domain; numbers their
length, notation, first digit (phone, card; of a phone number with country code 1 the first two), country
(IBAN) and valid check digits (card, IBAN); addresses being private or link-local; given names gender and
script, family names script and, in Cyrillic, a feminine ending; capitals.  The gender is the listed
name's, else that of most titles before the name in the corpus; if there are none or they tie, any.

A name is a capitalised word after a title, a listed given name and a capitalised word, or two
capitalised words after one of CUES.  An e-mail address has at most 64 characters before the @, and 127
labels of 63 behind it, the most that addresses can have.

Cases: null texts stay null, empty texts empty.  Repeated rows get the same text.  Texts without an
entity are passed on as they are.  Other columns, of any name, are kept unless `keep` names fewer (a
column n_entities gives way to the result).  No pattern repeats a group without bound, so texts of any
length are read in bounded stack.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_names, materialise

# Given names by gender and script, from which surrogates are drawn as well.
GIVEN = {
    ("f", "latin"): "aisha alice amina anna barbara carla carmen chiara claire deepa diana elena elif emma fatima grace hanna helen ingrid irene jane julia karen keiko khadija laura leila linda lucia maria martha mei ngozi nora olivia paula priya rosa sakura sarah sofia sophie svetlana teresa xiu yasmin yuki zainab".split(),
    ("m", "latin"): "adam ahmed ali albert amir arjun bernard carlos chen daniel david diego dmitri edward felix george giovanni hans hassan henry hiroshi hugo ibrahim ivan james jin john jorge jose joseph juan kenji kwame lucas luigi mark martin mohammed mustafa oscar pablo paul pedro peter raj robert sanjay sergei stefan takeshi taro thomas tunde victor wei".split(),
    ("f", "cyrillic"): "анна вера дарья елена ирина мария наталья ольга светлана татьяна".split(),
    ("m", "cyrillic"): "алексей андрей борис виктор дмитрий иван николай павел сергей юрий".split(),
}
# Titles that come before a name, by gender.
TITLES = {"f": "Mrs Ms Miss Frau Madame Mme Señora Sra Госпожа".split(), "m": "Mr Herr Monsieur Señor Sr Господин".split(), "x": "Dr Prof Доктор".split()}
# Syllables of drawn names.
SYLLABLES = {"latin": "ba be bo da de do ga go ha ka ke ko la le lo ma me mo na ne no pa ra re ro sa se so ta te to va".split(), "cyrillic": "ба бе бо ва ве во да де до га ка ке ко ла ле ло ма ме мо на не но па ра ре ро са се со та те то".split()}

# What comes right before the name of a person.
CUES = ["name is ", "Name: ", "Contact: ", "Signed: ", "Sincerely, ", "Regards, "]

_CAP = r"\p{Lu}[\p{L}'-]+"
_TITLE = "(?:" + "|".join(t for k in TITLES.values() for t in k) + r")\.? "
_GIVEN = "(?:" + "|".join(x for k in GIVEN.values() for n in k for x in (n.title(), n.upper())) + ")"
# What entities look like.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,125}\.[A-Za-z]{2,24}"
IP = r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?![\d.]*\d)"
IP6 = r"(?<![\w:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?=[A-Fa-f:]{0,39}\d)(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![\w:])"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
CARD = r"(?<![\d-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3})(?![\d-])"
PHONE = r"(?:\+\d{1,3}[ .-]?(?:\(\d{2,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,3}|\(\d{3}\) ?\d{3}[ .-]\d{4}|(?<![\d-])\d{3}[.-]\d{3}[.-]\d{4})(?![\d-])"
NAME = rf"(?<!\p{{L}})(?:{_TITLE}{_CAP}(?: {_CAP})?|{_GIVEN} {_CAP}|(?<={'|'.join(CUES)}){_CAP} {_CAP})(?!\p{{L}})"
#: Looking ahead for a first character that fits saves trying every kind at every place.
ENTITY = rf"(?:{EMAIL})|(?=[0-9+(])(?:{IP}|{SSN}|{CARD}|{PHONE})|(?=[0-9A-Fa-f]{{1,4}}:)(?:{IP6})|(?=[A-Z][A-Z]\d)(?:{IBAN})|(?=\p{{Lu}})(?:{NAME})"


def _array(values):
    return F.array(*[F.lit(v) for v in values])


def _cyrillic(x):
    return F.when(x.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")


def _whole_ip6(m):
    """All eight groups of an IPv6 address, in lower case without leading zeros."""
    groups = lambda x: F.filter(F.split(x, ":"), lambda g: g != "")
    left, right = groups(F.split_part(m, F.lit("::"), F.lit(1))), groups(F.when(m.contains("::"), F.split_part(m, F.lit("::"), F.lit(2))).otherwise(""))
    zeros = F.array_repeat(F.lit("0"), F.greatest(F.lit(8) - F.size(left) - F.size(right), F.lit(0)))
    return F.array_join(F.transform(F.concat(left, zeros, right), lambda g: F.regexp_replace(F.lower(g), "^0+(?=.)", "")), ":")


def parts(m):
    """The entities in a match: an array of (kind, canon, gender); gender, where a title tells it, is of a given name."""
    entity = lambda kind, canon, gender=F.lit(""): F.struct(kind.alias("kind"), canon.alias("canon"), gender.alias("gender"))
    digits = F.regexp_replace(m, r"\D", "")
    bare = F.regexp_replace(m, "^" + _TITLE, "")
    title = F.regexp_extract(m, "^" + _TITLE, 0)
    first, last = F.lower(F.split_part(bare, F.lit(" "), F.lit(1))), F.lower(F.split_part(bare, F.lit(" "), F.lit(-1)))
    titled = F.when(title.rlike("^(?:" + "|".join(TITLES["f"]) + r")\b"), "f").when(title.rlike("^(?:" + "|".join(TITLES["m"]) + r")\b"), "m").otherwise("")
    ending = F.when(last.rlike("[ая]$"), ":f").otherwise("")
    family = entity(F.concat(F.lit("family:"), _cyrillic(last), F.when(_cyrillic(last) == "cyrillic", ending).otherwise("")), last)
    given = entity(F.concat(F.lit("given:"), _cyrillic(first)), first, titled)
    phone = F.when(~m.startswith("+") & (F.length(digits) == 10), F.concat(F.lit("1"), digits)).otherwise(digits)
    return (
        F.when(m.contains("@"), F.array(entity(F.lit("email"), F.lower(m))))
        .when(m.rlike(f"^(?:{IP})$"), F.array(entity(F.lit("ip"), m)))
        .when(m.rlike(f"^(?:{IP6})$"), F.array(entity(F.lit("six"), _whole_ip6(m))))
        .when(m.rlike(f"^(?:{IBAN})$"), F.array(entity(F.lit("iban"), F.regexp_replace(m, " ", ""))))
        .when(m.rlike(f"^(?:{SSN})$"), F.array(entity(F.lit("ssn"), digits)))
        .when(m.rlike(f"^(?:{CARD})$"), F.array(entity(F.lit("card"), digits)))
        .when(m.rlike(r"^[+(\d]"), F.array(entity(F.lit("phone"), phone)))
        .when(bare.contains(" "), F.array(given, family))
        .otherwise(F.array(family))
    )


def gendered(found: DataFrame) -> DataFrame:
    """Distinct kind and canon of found (kind, canon, gender); a given name's kind ends with its gender: f, m or x."""
    women, men = (_array([n for (g, _), v in GIVEN.items() if g == k for n in v]) for k in "fm")
    votes = lambda g: F.count(F.when(F.col("gender") == g, 1))
    told = F.when(F.array_contains(women, F.col("canon")), "f").when(F.array_contains(men, F.col("canon")), "m").when(F.col("f") > F.col("m"), "f").when(F.col("m") > F.col("f"), "m").otherwise("x")
    each = found.groupBy("kind", "canon").agg(votes("f").alias("f"), votes("m").alias("m"))
    return each.select("kind", "canon", F.when(F.col("kind").startswith("given"), F.concat("kind", F.lit(":"), told)).otherwise(F.col("kind")).alias("type"))


def _draw(seed, i):
    """A keyed number for place i."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", seed, i.cast("string")), 256), 1, 8), 16, 10).cast("long")


def _places(canon):
    return F.sequence(F.lit(1), F.length(canon))


def surrogate(key: str, kind, canon, attempt):
    """The draw of the given attempt."""
    seed = F.concat_ws("|", F.lit(key), kind, canon, attempt.cast("string"))
    letters = F.lit("abcdefghijklmnopqrstuvwxyz")

    def shaped(text, seed):
        """Letters become letters, digits digits."""
        at = lambda i: F.substring(text, i, F.lit(1))
        own = lambda i: F.when(at(i).rlike("[a-z]"), F.substring(letters, (_draw(seed, i) % 26 + 1).cast("int"), F.lit(1))).when(at(i).rlike("[0-9]"), (_draw(seed, i) % 10).cast("string")).otherwise(at(i))
        return F.array_join(F.transform(_places(text), own), "")

    domain = F.split_part(canon, F.lit("@"), F.lit(-1))
    top = F.regexp_extract(domain, r"[^.]+$", 0)
    local = F.split_part(canon, F.lit("@"), F.lit(1))
    longer = F.when(attempt > 3, (_draw(seed, F.lit(0)) % 100000).cast("string")).otherwise("")
    email = F.concat(shaped(local, seed), longer, F.lit("@"), shaped(F.regexp_replace(domain, r"[^.]+$", ""), F.concat_ws("|", F.lit(key), F.lit("domain"), domain)), top)

    def digits(keep):
        own = lambda i: F.when(i <= keep, F.substring(canon, i, F.lit(1))).otherwise((_draw(seed, i) % 10).cast("string"))
        return F.array_join(F.transform(_places(canon), own), "")

    drawn = digits(F.when((kind == "phone") & canon.startswith("1") & (F.length(canon) == 11), 2).otherwise(1))
    body = F.substring(drawn, F.lit(1), F.length(canon) - 1)
    digit = lambda i: F.substring(body, i, F.lit(1)).cast("int")
    doubled = lambda i: F.when((F.length(body) - i) % 2 == 0, digit(i) * 2 - F.when(digit(i) > 4, 9).otherwise(0)).otherwise(digit(i))
    check = F.aggregate(F.transform(F.sequence(F.lit(1), F.length(body)), doubled), F.lit(0), lambda a, x: a + x)
    card = F.concat(body, ((10 - check % 10) % 10).cast("string"))
    octet = lambda i: (_draw(seed, F.lit(i)) % 254 + 1).cast("string")
    private = F.regexp_extract(canon, r"^(?:10\.|192\.168\.|127\.)", 0)
    fixed = F.length(F.regexp_replace(private, r"[^.]", ""))
    ip = F.concat(private, F.array_join(F.slice(F.array(*[octet(i) for i in range(4)]), F.lit(1), F.lit(4) - fixed), "."))

    group = lambda i: F.lower(F.hex(_draw(seed, F.lit(i)) % 65535 + 1))
    head = F.when(canon.rlike("^fe80:"), "fe80").when(canon.rlike("^f[cd]"), "fd00").otherwise("2001:db8")
    six = F.array_join(F.slice(F.array(head, *[group(i) for i in range(8)]), F.lit(1), F.when(head == "2001:db8", 7).otherwise(8)), ":")
    shape = lambda i: F.substring(canon, i, F.lit(1))
    own = lambda i: F.when(shape(i).rlike("[A-Z]"), F.upper(F.substring(letters, (_draw(seed, i) % 26 + 1).cast("int"), F.lit(1)))).otherwise((_draw(seed, i) % 10).cast("string"))
    account = F.array_join(F.transform(F.sequence(F.lit(5), F.length(canon)), own), "")
    country = F.substring(canon, F.lit(1), F.lit(2))
    moved = F.concat(account, country, F.lit("00"))
    value = lambda i: F.conv(F.substring(moved, i, F.lit(1)), 36, 10).cast("int")
    rest = F.aggregate(F.transform(F.sequence(F.lit(1), F.length(moved)), value), F.lit(0), lambda a, v: (a * F.when(v > 9, 100).otherwise(10) + v) % 97)
    iban = F.concat(country, F.lpad((98 - rest).cast("string"), 2, "0"), account)

    def syllables(script, n):
        names = _array(SYLLABLES[script])
        return F.array_join(F.transform(F.sequence(F.lit(1), n), lambda i: F.element_at(names, (_draw(seed, i) % len(SYLLABLES[script]) + 1).cast("int"))), "")

    more = F.least(F.lit(3) + F.floor(attempt / 4), F.lit(12)).cast("int")
    family = F.when(kind.contains("cyrillic"), F.concat(syllables("cyrillic", more), F.when(kind.endswith(":f"), "ва").otherwise("в"))).otherwise(syllables("latin", more))
    given = F.lit(None).cast("string")
    # Endings of drawn given names.
    endings = {"f": {"latin": "na", "cyrillic": "на"}, "m": {"latin": "n", "cyrillic": "н"}, "x": {"latin": "lin", "cyrillic": "лин"}}
    for script in ("latin", "cyrillic"):
        for gender in "fmx":
            names = [n for g in (gender if gender != "x" else "fm") for n in GIVEN[g, script]]
            listed = F.element_at(_array(names), (_draw(seed, F.lit(0)) % len(names) + 1).cast("int"))
            drawn_name = F.when(attempt < 3, listed).otherwise(F.concat(syllables(script, more - 1), F.lit(endings[gender][script])))
            given = F.when(kind == f"given:{script}:{gender}", drawn_name).otherwise(given)
    return (
        F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "six", six).when(kind == "iban", iban).when(kind == "card", card).when(kind == "ssn", digits(F.lit(0)))
        .when(kind == "phone", drawn).when(kind.startswith("given"), given).otherwise(family)
    )


def _space(kind):
    """Surrogates of kinds in one space must differ from one another."""
    return F.regexp_extract(kind, "^[a-z]+", 0)


#: Entities that one task draws for.
DRAWS = 1000


def assign(entities: DataFrame, key: str, most_rounds: int = 60) -> DataFrame:
    """kind, canon, surrogate: distinct, and none an entity itself.  entities: what `gendered` gives."""
    entities = materialise(entities.withColumn("space", _space(F.col("kind"))), "entities")
    originals = entities.select("space", F.col("canon").alias("surrogate")).distinct()
    done, pending = None, entities
    for attempt in range(most_rounds):
        tasks = max(1, math.ceil(pending.count() / DRAWS))
        drawn = pending.repartition(tasks, "kind", "canon").withColumn("surrogate", surrogate(key, F.col("type"), F.col("canon"), F.lit(attempt)))
        free = drawn.join(originals, ["space", "surrogate"], "left_anti")
        if done is not None:
            free = free.join(done.select("space", "surrogate"), ["space", "surrogate"], "left_anti")
        won = free.groupBy("space", "surrogate").agg(F.min(F.struct("kind", "canon")).alias("e")).select("space", "surrogate", "e.kind", "e.canon")
        done = materialise(won if done is None else done.unionByName(won), "surrogates")
        pending = materialise(entities.join(done.select("kind", "canon"), ["kind", "canon"], "left_anti"), "pending")
        if pending.isEmpty():
            return done.select("kind", "canon", "surrogate")
    raise RuntimeError(f"{most_rounds} rounds left entities without surrogate")


def rendered(m, first, second):
    """The match m with its surrogates in its own notation."""
    at = lambda i: F.substring(m, i, F.lit(1))

    def spread(fits, kept):
        """The surrogate's characters in place of those of m that fit; what m leaves out (a country code) is left out from the left."""
        left_out = F.length(first) - F.length(F.regexp_replace(m, kept, ""))
        place = lambda i: left_out + F.length(F.regexp_replace(F.substring(m, F.lit(1), i), kept, ""))
        return F.array_join(F.transform(_places(m), lambda i: F.when(at(i).rlike(fits), F.substring(first, place(i), F.lit(1))).otherwise(at(i))), "")

    bare = F.regexp_replace(m, "^" + _TITLE, "")
    title = F.regexp_extract(m, "^" + _TITLE, 0)
    loud = (F.upper(bare) == bare) & (F.length(bare) > 1)
    cased = lambda x: F.when(loud, F.upper(x)).otherwise(F.initcap(x))
    name = F.concat(title, F.when(second.isNull(), cased(first)).otherwise(F.concat(cased(first), F.lit(" "), cased(second))))
    email = F.when(F.upper(m) == m, F.upper(first)).otherwise(first)
    return (
        F.when(m.contains("@"), email).when(m.rlike(f"^(?:{IP})$|^(?:{IP6})$"), first).when(m.rlike(f"^(?:{IBAN})$"), spread("[A-Z0-9]", " "))
        .when(m.rlike(r"^[+(\d]"), spread(r"\d", r"\D")).otherwise(name)
    )


def replace_pii(docs: DataFrame, key: str, keep: list[str] | None = None) -> DataFrame:
    """docs (the columns of keep, or all) with surrogates in text, and n_entities, the number of replacements."""
    keep = [c for c in keep or docs.columns if c != "n_entities"]
    ms, t, own = free_names(keep, "matches", "text_key", "surrogates")
    # One pass over the texts: what is found is written beside them, so nothing is searched again but the texts that have entities.
    found_in = F.when(F.col("text").rlike(ENTITY), F.regexp_extract_all("text", F.lit(ENTITY), F.lit(0)))
    docs = materialise(docs.select(*keep).withColumn(ms, found_in), "pii-docs")
    texts = docs.filter(F.col(ms).isNotNull())
    found = texts.select(F.md5("text").alias("t"), F.col(ms).alias("ms")).groupBy("t").agg(F.first("ms").alias("ms"))
    found = found.select("t", F.posexplode("ms").alias("pos", "m"))
    found = materialise(found.select("t", "pos", "m", F.posexplode(parts(F.col("m"))).alias("part", "e")).select("t", "pos", "m", "part", "e.*"), "pii-found")
    table = assign(gendered(found), key)
    named = found.join(table, ["kind", "canon"])
    pick = lambda k: F.max(F.when(F.col("part") == k, F.col("surrogate")))
    named = named.groupBy("t", "pos", "m").agg(pick(0).alias("a"), pick(1).alias("b"))
    named = named.select("t", F.struct("pos", rendered(F.col("m"), F.col("a"), F.col("b")).alias("s")).alias("r"))
    named = named.groupBy("t").agg(F.transform(F.sort_array(F.collect_list("r")), lambda r: r["s"]).alias("s")).toDF(t, own)
    pieces = F.split("text", ENTITY, -1)
    joined = F.array_join(F.flatten(F.zip_with(pieces, own, lambda p, s: F.array(p, F.coalesce(s, F.lit(""))))), "")
    changed = texts.withColumn(t, F.md5("text")).join(named, t)
    changed = changed.withColumns({own + "_n": F.size(own).cast("long"), "text": joined}).select(*keep, F.col(own + "_n").alias("n_entities"))
    same = docs.filter(F.col(ms).isNull()).select(*keep, F.lit(0).cast("long").alias("n_entities"))
    return changed.unionByName(same)
