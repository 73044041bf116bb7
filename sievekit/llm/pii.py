"""Personal data: detection and surrogate generation, in DataFrame functions only.

Detected are e-mail addresses, IPv4 addresses, card numbers (with a valid check digit),
social security numbers, phone numbers (with a country code in any grouping or none; without
one in groups of 3, 3 and 4 digits, or with a leading 0 as in French and German numbers),
secrets (after a word such as ``token =``, digits too, or of a known form) and persons (a form of address or a listed given name with a surname).

Every entity is made of parts: a person of given name and surname, an address of local part
and domain. A part is replaced by a surrogate derived from an HMAC of its kind and
canonical form, so the same person, number or domain gets the same surrogate everywhere and
in every spelling (coreference). Surrogates keep the type and the form: given names change
within gender and script, Cyrillic surnames keep their ending and its gender, letters stay
letters of their script, vowels vowels, digits digits, octets keep their length, card numbers
their issuer digit and a valid check digit. Names of a document's persons that stand alone
elsewhere in it are replaced as well.

The corpus's different parts form a table of their own. Surrogates are checked over all of
it: one that another part has, or that occurs as an original, is derived anew with the next
attempt, until different originals have different surrogates and none is an original. Given
names come from closed lists: those that are no original are dealt first, and only where the
corpus holds more than half of a list do originals come back, never as themselves.

Texts are searched once: the table of cut texts that this gives is written and read by all
that follows. No pattern repeats a group without a small bound, so that Java's matcher never
recurses along a text.
"""

from __future__ import annotations

import hashlib
import hmac
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

#: Session setting with the secret key.
KEY_SETTING = "spark.sievekit.surrogates.key"
#: The key of the registered query and the pipeline where that setting is empty: known to
#: anyone who reads this, so good for trials only.
TRIAL_KEY = "trial key, not secret"

# Given names by gender and script.
GIVEN = {
    "given_f_latin": "alice anna barbara carmen catherine christine clara claire elena elizabeth emily emma eva helen isabel jane julia laura linda louise lucy margaret maria marie martha mary nina olivia paula rosa sarah silvia sofia sophie susan teresa ursula victoria aisha amélie chloé fatima ingrid lucía mei zoé",
    "given_m_latin": "adam albert alexander andrew anthony antonio carlos charles daniel david edward eric ernst francis frank fred george hans henry hugo jack jacques james jean john jose joseph juan karl louis luis martin michael miguel oliver otto patrick paul pedro peter pierre richard robert samuel stefan thomas victor walter william wolfgang ahmed andré björn françois jesús josé jürgen mohammed rené wei",
    "given_f_cyrillic": "александра анастасия анна валентина вера виктория галина дарья екатерина елена елизавета зоя ирина ксения лариса людмила марина мария наталья нина ольга полина светлана софья татьяна юлия",
    "given_m_cyrillic": "александр алексей андрей антон артём борис василий виктор владимир георгий григорий денис дмитрий евгений иван игорь илья кирилл константин максим михаил никита николай олег павел пётр роман сергей степан юрий",
}
# Forms of address.
TITLES = "Mr Mrs Ms Miss Dr Prof Monsieur Madame Herr Frau Señor Señora г-н г-жа".split()

VOWELS = {"latin": "aeiou", "cyrillic": "аеиоуэюя"}
CONSONANTS = {"latin": "bcdfghjklmnpqrstvwxz", "cyrillic": "бвгджзклмнпрстфхцчш"}

_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_NAMES = "|".join(sorted((n[0].upper() + n[1:] for x in GIVEN.values() for n in x.split()), key=lambda n: (-len(n), n)))
_TITLE = "|".join(sorted(TITLES, key=lambda n: (-len(n), n)))
_SURNAME = r"\p{Lu}\p{Ll}++(?:-\p{Lu}\p{Ll}++)?"

#: Patterns by kind, in the order in which they are tried at a place.
PATTERNS = {
    "secret": r"(?<![A-Za-z0-9_\-])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,64}"
    r"|(?=[A-Za-z0-9_\-+/=.]{8})(?<=(?i:token|secret|password|passwd|api_?key)\s{0,3}[=:]\s{0,3}[\"']?)[A-Za-z0-9_\-+/=]++)",
    "email": r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}][\p{L}\p{N}._%+\-]*+@[\p{L}\p{N}][\p{L}\p{N}.\-]*\.\p{L}{2,}",
    "ip": rf"(?<![\w.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\w|\.\d)",
    "card": r"(?<![\w.\-+])(?:\d{13,19}|\d{4}([ \-])\d{4}\1\d{4}\1\d{4}|\d{4}[ \-]\d{6}[ \-]\d{5})(?![\w\-])",
    "ssn": r"(?<![\w\-])\d{3}-\d{2}-\d{4}(?![\w\-])",
    "phone": r"(?:(?<![\w(+\-])(?:(?:\+\d{1,3}[ .\-]?)?(?:\(\d{2,4}\)[ .\-]?|\d{3}[ .\-])\d{3}[ .\-]\d{4}|\+\d{1,3}(?:[ .\-]\d{2,4}){2,4}|0\d(?:[ .\-]\d{2}){4}|0\d{2,4}[ /\-]\d{5,8})"
    r"|(?<![\w+\-])\+(?:\d{7,15}|(?=\d(?:[ .\-()]{0,3}\d){6})\d{1,3}(?:[ .\-]?\(\d{1,5}\)[ .\-]?\d{1,8}|[ .\-]\d{1,8})(?:[ .\-]\d{1,8}){0,6}))(?![\w\-])",
    "person": rf"(?<![\p{{L}}\p{{N}}])(?=\p{{L}})(?:(?:{_TITLE})\.? (?:(?:{_NAMES}) )?{_SURNAME}|(?:{_NAMES}) {_SURNAME})(?!\p{{L}})",
}
#: All of them; group 1 is what matched as a secret. (The card's own group is the second.)
ENTITY = "|".join(f"({x})" if k == "secret" else x.replace(r"\1", r"\2") for k, x in PATTERNS.items())
#: Noncharacters that set off what was found, and its group 1, in a text.
EDGE, SECRET = "\ufdd0", "\ufdd1"
#: Before a secret that has the form of a card number.
MARK = "\u0001"
#: Holds in every text with an entity; cheap.
HINT = rf"[@0-9]|(?i:token|secret|passw|api_?key)|AKIA[A-Z]{{16}}|gh[pousr]_[A-Za-z]{{36}}|sk-[A-Za-z]{{20}}|(?<![\p{{L}}\p{{N}}])(?=[\p{{Lu}}г])(?:{_TITLE}|{_NAMES})\.? \p{{Lu}}"


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, r"\D", "")


def _luhn_sum(digits: Column, double_last: bool) -> Column:
    """Luhn sum of a string of digits; with double_last the last digit counts twice."""
    places = F.sequence(F.lit(1), F.length(digits))

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = (F.length(digits) - i) % 2 == (0 if double_last else 1)
        doubled = 2 * d
        return total + F.when(twice, F.when(doubled > 9, doubled - 9).otherwise(doubled)).otherwise(d)

    return F.aggregate(places, F.lit(0), add)


def kind_of(entity: Column) -> Column:
    """Kind of a matched entity; null if it is none after all (a wrong check digit and no
    MARK)."""
    digits = _digits(entity)
    numeric = ~entity.rlike(rf"[^0-9 \-{MARK}]")
    return (
        F.when(entity.rlike("^" + PATTERNS["email"] + "$"), "email")
        .when(entity.rlike("^" + PATTERNS["ip"] + "$"), "ip")
        .when(entity.rlike("^" + PATTERNS["ssn"] + "$"), "ssn")
        .when(entity.rlike("^" + PATTERNS["phone"] + "$"), "phone")
        .when(numeric & F.length(digits).between(13, 19), F.when(_luhn_sum(digits, False) % 10 == 0, "card").when(entity.startswith(MARK), "secret"))
        .when(entity.rlike("^(?:" + PATTERNS["person"] + ")$"), "person")
        .otherwise("secret")
    )


def parts_of(entity: Column, kind: Column) -> Column:
    """The entity's parts, array<struct<kind, canon, value>>; kind is null for what stays."""

    entity = F.ltrim(entity, F.lit(MARK))

    def name(token: Column) -> Column:
        low = F.lower(token)
        found = F.lit(None).cast("string")
        for k, names in GIVEN.items():
            found = F.when(low.isin(names.split()), k).otherwise(found)
        bare = F.regexp_replace(token, r"\.$", "")
        script = F.when(low.rlike("[а-яё]"), "surname_cyrillic").otherwise("surname_latin")
        part = F.when(bare.isin(TITLES), F.lit(None).cast("string")).otherwise(F.coalesce(found, script))
        # a surname's canonical form is the masculine one
        male = F.regexp_replace(F.regexp_replace(low, "(?<=ов|ев|ёв|ин|ын)а$", ""), "(?<=ск|цк)ая$", "ий")
        return F.struct(part.alias("kind"), F.when(part == "surname_cyrillic", male).otherwise(low).alias("canon"), token.alias("value"))

    def one(k: Column, canon: Column, value: Column) -> Column:
        return F.struct(k.alias("kind"), canon.alias("canon"), value.alias("value"))

    at = F.split(entity, "@")
    mail = F.array(one(F.lit("local"), F.lower(F.get(at, F.lit(0))), F.get(at, F.lit(0))), one(F.lit("domain"), F.lower(F.get(at, F.lit(1))), F.get(at, F.lit(1))))
    canon = F.when(kind.isin("card", "ssn", "phone"), _digits(entity)).otherwise(entity)
    return F.when(kind == "person", F.transform(F.split(entity, " "), name)).when(kind == "email", mail).otherwise(F.array(one(kind, canon, entity)))


def _draw(seed: Column, i: Column, n: int | Column) -> Column:
    """A number below n from the part's seed and place i."""
    return F.pmod(F.conv(F.substring(F.sha2(F.concat_ws("|", seed, i.cast("string")), 256), 1, 12), 16, 10).cast("long"), F.lit(n) if isinstance(n, int) else n)


def keyed(key: str, *parts: Column) -> Column:
    """HMAC-SHA-256 of the parts, in hex."""
    block = key.encode()
    block = (hashlib.sha256(block).digest() if len(block) > 64 else block).ljust(64, b"\0")
    inner, outer = (F.lit(bytes(x ^ pad for x in block)) for pad in (0x36, 0x5C))
    digest = F.sha2(F.concat(inner, F.concat_ws("|", *parts).cast("binary")), 256)
    return F.sha2(F.concat(outer, F.unhex(digest)), 256)


def _respelled(text: Column, seed: Column, hexadecimal: bool = False) -> Column:
    """text with each letter and digit drawn anew within its class, case and script."""

    def pick(alphabet: str, i: Column) -> Column:
        return F.substring(F.lit(alphabet), _draw(seed, i, len(alphabet)).cast("int") + 1, F.lit(1))

    def char(c: Column, i: Column) -> Column:
        out = F.when(c.rlike("[0-9]"), pick("0123456789", i))
        if hexadecimal:
            out = out.when(c.rlike("[a-f]"), pick("abcdef", i)).when(c.rlike("[A-F]"), pick("ABCDEF", i))
        for script in VOWELS:
            for alphabet in (VOWELS[script], CONSONANTS[script]):
                out = out.when(F.lit(alphabet).contains(c), pick(alphabet, i)).when(F.lit(alphabet.upper()).contains(c), pick(alphabet.upper(), i))
        # letters outside the plain alphabets: a consonant of the nearest script
        out = out.when(c.rlike(r"\p{IsCyrillic}"), F.when(c == F.lower(c), pick(CONSONANTS["cyrillic"], i)).otherwise(pick(CONSONANTS["cyrillic"].upper(), i)))
        return out.when(c.rlike(r"\p{L}"), F.when(c == F.lower(c), pick(VOWELS["latin"], i)).otherwise(pick(VOWELS["latin"].upper(), i))).otherwise(c)

    return F.array_join(F.transform(F.filter(F.split(text, ""), lambda c: c != ""), char), "")


def surrogate(kind: Column, canon: Column, seed: Column, attempt: int) -> Column:
    """The surrogate's canonical form, for all kinds but given names. Later attempts draw anew;
    after the eighth the form gives way: a drawn tail makes room where all short forms are taken.
    seed is the part's keyed digest for the attempt."""
    n = F.length(canon)
    keep = F.greatest(F.lit(0), n - 10)  # a phone number's country code
    top = F.regexp_extract(canon, r"^(.*)(\.[^.]+)$", 2)
    stem, ending = (F.regexp_extract(canon, "^(.+?)(ов|ев|ёв|ин|ын|ский|цкий|)$", i) for i in (1, 2))
    body = F.when(kind == "phone", F.substring(canon, keep + 1, F.lit(10))).when(kind == "card", F.substring(canon, F.lit(2), n - 2))
    body = body.when(kind == "domain", F.substring(canon, F.lit(1), n - F.length(top))).when(kind == "surname_cyrillic", stem).otherwise(canon)
    hexadecimal = (kind == "secret") & ~canon.rlike("[g-zG-Z]")
    spelled = F.when(hexadecimal, _respelled(canon, seed, True)).otherwise(_respelled(body, seed))

    def octet(o: Column, i: Column) -> Column:
        width = F.length(o) if attempt < 8 else F.lit(3)
        low, count = F.when(width == 1, 1).when(width == 2, 10).otherwise(100), F.when(width == 1, 9).when(width == 2, 90).otherwise(155)
        return (low + _draw(seed, i, count)).cast("string")

    ip = F.array_join(F.transform(F.split(canon, r"\."), octet), ".")
    tail = F.lit("") if attempt < 8 else F.substring(F.sha2(seed, 256), 1, min(8, attempt - 6))
    numbers = F.lit("") if attempt < 8 else F.translate(tail, "abcdef", "012345")

    def whole(x: Column) -> Column:
        card = F.concat(F.substring(canon, 1, 1), x)
        out = F.when(kind == "phone", F.concat(F.substring(canon, F.lit(1), keep), x, numbers)).when(kind == "ssn", F.concat(x, numbers))
        out = out.when(kind == "card", F.concat(card, F.pmod(-_luhn_sum(card, True), F.lit(10)).cast("string")))
        out = out.when(kind == "domain", F.concat(tail, x, top)).when(kind == "secret", F.concat(x, tail))
        out = out.when(kind == "surname_cyrillic", F.concat(x, F.translate(tail, "0123456789abcdef", "абвгдежзиклмнопр"), ending))
        return out.otherwise(F.concat(x, F.translate(tail, "0123456789", "ghijklmnop")))

    # spelled once, though named in every form
    return F.when(kind == "ip", ip).otherwise(F.get(F.transform(F.array(spelled), whole), F.lit(0)))


def given_names(present: dict[str, set[str]], key: str) -> dict[str, str]:
    """Surrogates of the listed names that a corpus holds: "kind|name" to a name of the same list.

    Each takes the name that ranks first by a keyed digest of both, of those that are neither
    taken nor present; where none is left, of those that are not taken, and not itself.
    """
    out = {}

    def rank(kind: str, name: str, other: str) -> bytes:
        return hmac.digest(key.encode(), f"given|{kind}|{name}|{other}".encode(), "sha256")

    for kind, listed in GIVEN.items():
        free = sorted(set(listed.split()) - present.get(kind, set()))
        rest, late = sorted(present.get(kind, set())), []
        for name in rest:
            if not free:
                late.append(name)
                continue
            best = min(free, key=lambda x, name=name, kind=kind: rank(kind, name, x))
            free.remove(best)
            out[f"{kind}|{name}"] = best
        # the others in a ring, or the one that is left in place of another's
        ring = sorted(late, key=lambda x, kind=kind: rank(kind, x, ""))
        for i, name in enumerate(ring):
            out[f"{kind}|{name}"] = ring[(i + 1) % len(ring)]
        if len(ring) == 1:
            other = next(x for x in rest if x != ring[0])
            out[f"{kind}|{ring[0]}"], out[f"{kind}|{other}"] = out[f"{kind}|{other}"], ring[0]
    return out


def dictionary(parts: DataFrame, key: str, work: str) -> DataFrame:
    """(kind, canon, surrogate) for distinct (kind, canon): different within a kind, and no
    surrogate outside the lists of given names is any original's canonical form."""
    listed = F.col("kind").startswith("given_")
    present: dict[str, set[str]] = {}
    for r in parts.filter(listed).distinct().collect():  # no more than the lists have
        present.setdefault(r["kind"], set()).add(r["canon"])
    dealt = given_names(present, key)
    names = F.create_map(*[F.lit(x) for pair in (dealt or {"": ""}).items() for x in pair])
    given = parts.filter(listed).select("kind", "canon", F.try_element_at(names, F.concat_ws("|", "kind", "canon")).alias("surrogate"))
    own = parts.filter(~listed).select("kind", "canon")
    originals = own.select("kind", F.col("canon").alias("surrogate"))

    def seeded(left: DataFrame, attempt: int) -> DataFrame:
        seed = keyed(key, F.col("kind"), F.col("canon"), F.lit(str(attempt)))
        return common.stored(left.select("kind", "canon", seed.alias("seed")), f"{work}/pending{attempt}")

    done, attempt = given, 0
    pending = seeded(own, 0)
    while True:
        drawn = pending.select("kind", "canon", surrogate(F.col("kind"), F.col("canon"), F.col("seed"), attempt).alias("surrogate"))
        drawn = common.stored(drawn, f"{work}/drawn{attempt}")
        ranked = drawn.withColumn("n", F.row_number().over(Window.partitionBy("kind", "surrogate").orderBy("canon")))
        taken = originals.union(done.select("kind", "surrogate"))
        good = ranked.filter("n = 1").drop("n").join(taken.distinct(), ["kind", "surrogate"], "left_anti").select("kind", "canon", "surrogate")
        good = common.stored(good, f"{work}/good{attempt}")
        done = done.union(good)
        attempt += 1
        pending = seeded(drawn.join(good, ["kind", "canon"], "left_anti"), attempt)
        if pending.isEmpty():
            return done


def cut(text: Column) -> Column:
    """What a text is made of, struct<between, found>; null if nothing is found in it.

    found are the entities, with MARK before the secrets that look like card numbers, and
    between what stands around them, one more.
    """
    # one pass of the pattern marks all; a text that holds the marks already takes three
    marked = F.split(F.regexp_replace(text, ENTITY, f"{EDGE}$0{SECRET}$1{EDGE}"), EDGE, -1)
    entities, secrets = (F.regexp_extract_all(text, F.lit(ENTITY), F.lit(i)) for i in (0, 1))
    zipped = F.arrays_zip(F.split(text, ENTITY, -1).alias("b"), entities.alias("e"), secrets.alias("s"))
    apart = F.flatten(F.transform(zipped, lambda z: F.when(z["e"].isNull(), F.array(z["b"])).otherwise(F.array(z["b"], F.concat(z["e"], F.lit(SECRET), z["s"])))))
    clean = ~text.contains(EDGE) & ~text.contains(SECRET)

    def entity(x: Column) -> Column:
        e = F.regexp_extract(x, f"(?s)^(.*){SECRET}", 1)
        return F.when(~x.endswith(SECRET) & e.rlike(r"^[0-9][0-9\-]{11,}[0-9]$"), F.concat(F.lit(MARK), e)).otherwise(e)

    def parts(all_: Column) -> Column:
        between = F.filter(all_, lambda _, i: i % 2 == 0)
        found = F.transform(F.filter(all_, lambda _, i: i % 2 == 1), entity)
        return F.when(F.size(all_) > 1, F.struct(between.alias("between"), found.alias("found")))

    # the text is searched once, though parts names the result several times
    pieces = F.when(F.coalesce(text.rlike(HINT), F.lit(False)), F.when(clean, marked).otherwise(apart))
    return F.get(F.transform(F.array(pieces), parts), F.lit(0))


def _respell_like(value: Column, kind: Column, canon: Column, new: Column) -> Column:
    """The surrogate in the value's form: separators between digits, case and gender of names."""
    female = (kind == "surname_cyrillic") & (F.lower(value) != canon)
    new = F.when(female & new.endswith("ий"), F.regexp_replace(new, "ий$", "ая")).when(female, F.concat(new, F.lit("а"))).otherwise(new)

    def put(state: Column, c: Column) -> Column:
        digit = c.rlike("[0-9]")
        out = F.concat(state["out"], F.when(digit, F.substring(new, state["k"] + 1, F.lit(1))).otherwise(c))
        return F.struct(out.alias("out"), (state["k"] + digit.cast("int")).alias("k"))

    chars = F.filter(F.split(value, ""), lambda c: c != "")
    filled = F.aggregate(chars, F.struct(F.lit("").alias("out"), F.lit(0).alias("k")), put)
    digits = F.concat(filled["out"], F.substring(new, filled["k"] + 1, F.lit(64)))
    cased = F.when(value == F.lower(value), new).when((value == F.upper(value)) & (F.length(value) > 1), F.upper(new)).otherwise(F.concat(F.upper(F.substring(new, 1, 1)), F.substring(new, F.lit(2), F.length(new))))
    return F.when(kind.isin("card", "ssn", "phone"), digits).when(kind.isin("ip", "secret"), new).otherwise(cased)


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """docs with every detected entity of text_col replaced by its surrogate.

    key is the secret of the surrogates: whoever has it can repeat them. With count_col, a long
    column of that name counts the entities replaced (not the names that stand alone). Null and
    empty texts stay as they are; rows, repeated ones too, and other columns stay; an empty
    table stays empty. Texts are searched whole. A column of docs named count_col is replaced.
    """
    if not key:
        raise ValueError("surrogates need a key")
    spark = docs.sparkSession
    work = common.shared_dir(spark)
    names = [c for c in docs.columns if c != count_col]
    found = docs.select(*names, F.monotonically_increasing_id().alias("__row"), cut(F.col(text_col)).alias("__cut"))
    found = common.stored(found, f"{work}/found")
    hit = found.filter("__cut is not null")
    mentions = hit.select("__row", F.explode(F.array_distinct("__cut.found")).alias("entity"))
    entities = common.stored(mentions.select("entity").distinct(), f"{work}/entities").withColumn("kind", kind_of(F.col("entity"))).filter("kind is not null")
    pieces = entities.select("entity", F.col("kind").alias("whole"), F.posexplode(parts_of(F.col("entity"), F.col("kind"))).alias("place", "part")).select("entity", "whole", "place", "part.*")
    pieces = common.stored(pieces, f"{work}/pieces")
    table = dictionary(pieces.filter("kind is not null").select("kind", "canon").distinct(), key, work)
    joined = pieces.join(table, ["kind", "canon"], "left")
    new = F.when(F.col("surrogate").isNull(), F.col("value")).otherwise(_respell_like(F.col("value"), F.col("kind"), F.col("canon"), F.col("surrogate")))
    glue = F.when(F.col("whole") == "person", " ").when(F.col("whole") == "email", "@").otherwise("")
    ordered = F.sort_array(F.collect_list(F.struct("place", F.col("value").alias("old"), "new")))
    renamed = joined.select("entity", glue.alias("glue"), "place", "value", new.alias("new")).groupBy("entity", "glue").agg(ordered.alias("news"))
    # a person's names, for where they stand alone
    alone = F.when(F.col("glue") == " ", F.transform(F.filter("news", lambda p: p["old"] != p["new"]), lambda p: F.struct(p["old"].alias("old"), p["new"].alias("new"))))
    renamed = renamed.select("entity", F.expr("array_join(transform(news, p -> p.new), glue)").alias("renamed"), alone.alias("alone"))
    renamed = common.stored(renamed, f"{work}/renamed")
    lists = mentions.join(renamed, "entity").groupBy("__row").agg(F.map_from_entries(F.collect_list(F.struct("entity", "renamed"))).alias("__map"), F.sort_array(F.array_distinct(F.flatten(F.collect_list("alone")))).alias("__alone"))
    # a name that is a given name here and a surname there has the first of its surrogates alone
    first = F.filter("__alone", lambda p, i: (i == 0) | (F.get("__alone", i - 1)["old"] != p["old"]))
    lists = lists.select("__row", "__map", F.map_from_entries(first).alias("__names"))

    target = hit.join(lists, "__row", "left")
    renewed = F.transform("__cut.found", lambda e: F.coalesce(F.try_element_at("__map", e), F.ltrim(e, F.lit(MARK))))
    word = F.lit(r"[\p{L}\p{M}\-]+|[^\p{L}\p{M}\-]+")

    def bare(between: Column) -> Column:
        words = F.regexp_extract_all(between, word, F.lit(0))
        return F.when(F.size("__names") > 0, F.array_join(F.transform(words, lambda w: F.coalesce(F.try_element_at("__names", w), w)), "")).otherwise(between)

    rebuilt = F.array_join(F.transform(F.arrays_zip(F.transform("__cut.between", bare).alias("a"), renewed.alias("b")), lambda x: F.concat(x["a"], F.coalesce(x["b"], F.lit("")))), "")
    number = F.size(F.filter("__cut.found", lambda e: F.coalesce(F.map_contains_key("__map", e), F.lit(False)))).cast("long")
    counted = {} if count_col is None else {count_col: number}
    changed = target.withColumns({**counted, text_col: rebuilt}).drop("__row", "__cut", "__map", "__names")
    same = found.filter("__cut is null").drop("__row", "__cut")
    if count_col is not None:
        same = same.withColumn(count_col, F.lit(0).cast("long"))
    return reduce(DataFrame.unionByName, [same, changed])


def session_key(spark: SparkSession) -> str:
    """The key in KEY_SETTING, or else TRIAL_KEY."""
    return spark.conf.get(KEY_SETTING, None) or TRIAL_KEY


def op5_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, text with surrogates and the count of entities, for all documents, under the
    session's key. Edge cases are those of pseudonymise; other columns are ignored."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pseudonymise(docs, session_key(spark), count_col="n_entities")
