"""Keyed surrogates for personal data, in DataFrame operations only.

Detected entities get replacements of the same type, format, script and gender,
derived from a secret key, so that one entity has one surrogate in the whole
corpus. Surrogates are checked against each other and against all real entities
and drawn again until every entity has one of its own.
"""

from __future__ import annotations

import hashlib
import hmac

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import settled

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
# Forms of address by gender. A name is one or two capitalised words after one of them.
MALE = ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Signor", "Г-н", "Господин", "Κύριος"]
FEMALE = ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Signora", "Г-жа", "Госпожа", "Κυρία"]
# Forms of address that do not tell; their bearers get names of the first kind.
OTHER = ["Dr", "Prof", "Sir", "Dra", "Д-р", "Δρ"]
_NAME = r"\p{Lu}[\p{L}'’-]+"
_TITLE = rf"(?<![\p{{L}}\p{{N}}-])(?:{'|'.join(sorted(MALE + FEMALE + OTHER, key=len, reverse=True))})\.? +"
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "ip": rf"(?<![0-9A-Za-z.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9A-Za-z]|\.[0-9])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
    "card": r"(?<![0-9A-Za-z.-])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z]|[.-][0-9])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "phone": r"(?<![0-9A-Za-z+.-])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9A-Za-z]|[.-][0-9])",
    "person": rf"{_TITLE}{_NAME}(?: {_NAME})?",
}
PATTERN = "|".join(f"(?:{p})" for p in PATTERNS.values())
# Where a wide stretch of digits has a wrong check digit: cards in one run or in their usual groups only.
_NARROW_CARD = r"(?<![0-9A-Za-z.-])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9A-Za-z]|[.-][0-9])"
NARROW_PATTERN = "|".join(f"(?:{_NARROW_CARD if n == 'card' else p})" for n, p in PATTERNS.items())
#: No mention without one of these.
_HINT = rf"[0-9@]|{_TITLE}"

# Syllables for made-up names, by script.
SYLLABLES = {
    "latin": "ba be bi bo bra da de di do dra fa fe ga ge go ka ke ki ko la le li lo lu ma me mi mo na ne ni no pa pe po ra re ri ro sa se si so ta te ti to va ve vi".split(),
    "cyrillic": "ба бе би бо бра да де ди до дра ва ве ви га го ка ке ки ко ла ле ли ло лу ма ме ми мо на не ни но па пе по ра ре ри ро са се си со та те ти то".split(),
    "greek": "βα βε βι βο γα γο δα δε δι δο κα κε κι κο λα λε λι λο μα με μι μο να νε νι νο πα πε πο ρα ρε ρι ρο σα σε σι σο τα τε τι το".split(),
}
# Endings of given names by script and gender, and of surnames by script.
ENDINGS = {
    "latin": {"male": "n", "female": "na", "surname": "r"},
    "cyrillic": {"male": "н", "female": "на", "surname": "ров"},
    "greek": {"male": "νος", "female": "να", "surname": "ρης"},
}


def _sql_list(items: list[str]) -> str:
    return ", ".join("'" + x.replace("'", "''") + "'" for x in items)


def _digits(e: str) -> str:
    return f"regexp_replace({e}, '[^0-9]', '')"


def _luhn(digits: str) -> str:
    """SQL for the check digit that goes after ``digits``."""
    d = f"cast(substr({digits}, i, 1) as int)"
    doubled = f"if(2 * {d} > 9, 2 * {d} - 9, 2 * {d})"
    return (
        f"pmod(10 - aggregate(sequence(1, length({digits})), 0, "
        f"(a, i) -> a + if((length({digits}) - i) % 2 = 0, {doubled}, {d})) % 10, 10)"
    )


def _mod97(text: str) -> str:
    """SQL for digits and capital letters, A as 10 to Z as 35, read as one number modulo 97."""
    c = f"substr({text}, i, 1)"
    return (
        f"aggregate(sequence(1, length({text})), 0L, (a, i) -> if({c} RLIKE '[0-9]', (a * 10 + cast({c} as int)) % 97, "
        f"(a * 100 + ascii({c}) - 55) % 97))"
    )


def mentions(text: str) -> Column:
    """All mentions of a text from left to right; an empty list for a null text."""
    found = F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))
    return F.when(F.coalesce(F.rlike(text, F.lit(_HINT)), F.lit(False)), found).otherwise(F.array().cast("array<string>"))


def pieces(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` with ``__pieces``: a text with mentions ``__found`` as a list of (gap, mention), the last mention null.

    The card pattern may take a date, an id and a phone number for one card.
    Where its check digit is wrong, the text up to the next mentions on both
    sides is searched again, for cards in their usual forms only.
    """
    digits = _digits("m")
    failed = F.expr(
        f"transform(__found, m -> m RLIKE '^[0-9][0-9 -]+$' AND length({digits}) >= 13 AND "
        f"{_luhn(f'substr({digits}, 1, length({digits}) - 1)')} != cast(right({digits}, 1) as int))"
    )
    rows = rows.withColumns({"__failed": failed, "__gaps": F.split(text, PATTERN)})
    plain = F.expr("transform(__gaps, (g, i) -> struct(g as gap, get(__found, i) as mention))")
    # Failed mentions go back into the gap before the next mention.
    joined = F.expr(
        "aggregate(__gaps, struct(cast(array() as array<struct<gap: string, mention: string, again: boolean>>) as done, "
        "'' as open, false as again, 0 as i), (a, g) -> if(coalesce(get(__failed, a.i), false), "
        "struct(a.done as done, concat(a.open, g, get(__found, a.i)) as open, true as again, a.i + 1 as i), "
        "struct(array_append(a.done, struct(concat(a.open, g) as gap, get(__found, a.i) as mention, a.again as again)) as done, "
        "'' as open, false as again, a.i + 1 as i))).done"
    )

    def searched(p: Column) -> Column:
        gaps = F.split(p["gap"], NARROW_PATTERN)
        inner = F.transform(
            F.regexp_extract_all(p["gap"], F.lit(NARROW_PATTERN), F.lit(0)),
            lambda m, i: F.struct(F.get(gaps, i).alias("gap"), m.alias("mention")),
        )
        last = F.struct(F.element_at(gaps, -1).alias("gap"), p["mention"].alias("mention"))
        kept = F.array(F.struct(p["gap"].alias("gap"), p["mention"].alias("mention")))
        return F.when(p["again"], F.concat(inner, F.array(last))).otherwise(kept)

    again = F.flatten(F.transform(joined, searched))
    some = F.exists("__failed", lambda x: x)
    return rows.withColumn("__pieces", F.when(some, again).otherwise(plain)).drop("__failed", "__gaps")


def _kinds(rows: DataFrame) -> DataFrame:
    """(mention, part, kind, canon, word): the entities in a mention; a person has one per word of the name."""
    kind = F.lit(None).cast("string")
    for name, pattern in reversed(PATTERNS.items()):
        kind = F.when(F.rlike("mention", F.lit(f"^(?:{pattern})$")), name).otherwise(kind)
    digits = _digits("mention")
    real_card = F.expr(f"{_luhn(f'substr({digits}, 1, length({digits}) - 1)')} = cast(right({digits}, 1) as int)")
    typed = rows.select("mention", kind.alias("kind")).where((F.col("kind") != "card") | real_card)
    # A country code other than 1, which numbers without one have, is part of the number.
    national = _digits("regexp_replace(mention, '^[+][0-9]+', '')")
    canon = F.expr(
        f"CASE kind WHEN 'email' THEN lower(mention) WHEN 'ip' THEN mention WHEN 'iban' THEN replace(mention, ' ', '') "
        f"WHEN 'phone' THEN if(mention RLIKE '^[+](?!1[^0-9])', concat(regexp_extract(mention, '^([+][0-9]+)', 1), ':', {national}), {national}) "
        f"ELSE {digits} END"
    )
    plain = typed.where("kind != 'person'").select(
        "mention", F.lit(0).alias("part"), "kind", canon.alias("canon"), F.col("mention").alias("word")
    )
    title = F.regexp_extract("mention", rf"^[\p{{L}}-]+", 0)
    words = F.split(F.regexp_replace("mention", r"^[\p{L}-]+\.? +", ""), " ")
    people = typed.where("kind = 'person'").select(
        "mention", F.when(title.isin(FEMALE), "female").otherwise("male").alias("gender"),
        F.size(words).alias("n"), F.posexplode(words).alias("part", "word"),
    )
    script = F.when(F.rlike("word", F.lit(r"\p{IsCyrillic}")), "cyrillic").when(F.rlike("word", F.lit(r"\p{IsGreek}")), "greek").otherwise("latin")
    role = F.when(F.col("part") == F.col("n") - 1, "surname").otherwise(F.col("gender"))
    named = people.select(
        "mention", "part", F.concat_ws(":", F.lit("name"), script, role).alias("kind"), F.lower("word").alias("canon"), "word"
    )
    return plain.unionAll(named)


def _drawn(entities: DataFrame, key: str) -> DataFrame:
    """``entities`` (kind, canon, attempt) with the surrogate of this attempt."""
    seed = f"concat('{key}', '|', kind, '|', canon, '|', cast(attempt as string), '|'"
    h = f"concat(sha2({seed}, 'a'), 256), sha2({seed}, 'b'), 256))"
    rows = entities.withColumn("h", F.expr(h))
    pair = "cast(conv(substr(h, 1 + 2 * ((i - 1) % 64), 2), 16, 10) as int)"
    c = "substr(canon, i, 1)"
    letter = (
        f"CASE WHEN {c} RLIKE '[a-z]' THEN substr('abcdefghijklmnopqrstuvwxyz', 1 + {pair} % 26, 1) "
        f"WHEN {c} RLIKE '[A-Z]' THEN substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ', 1 + {pair} % 26, 1) "
        f"WHEN {c} RLIKE '[0-9]' THEN cast({pair} % 10 as string) ELSE {c} END"
    )
    same_shape = f"array_join(transform(sequence(1, length(canon)), i -> {letter}), '')"
    # The last two labels of an address become a reserved domain, the others keep their shape.
    owner = r"regexp_extract(same, '^(.*?)(?:[A-Za-z0-9-]+\\.[A-Za-z]+)$', 1)"
    ending = r"if(canon RLIKE '\\.(com|org|net)$', regexp_extract(canon, '([a-z]+)$', 1), 'org')"
    octet = "cast(conv(substr(h, {0}, 4), 16, 10) as int)"
    # Private and loopback addresses stay so.
    ip = (
        f"concat_ws('.', CASE WHEN canon RLIKE '^(10|127)[.]' THEN regexp_extract(canon, '^([0-9]+)', 1) WHEN canon LIKE '192.168.%' THEN '192' "
        f"ELSE cast(1 + {octet.format(1)} % 223 as string) END, if(canon LIKE '192.168.%', 168, {octet.format(5)} % 256), "
        f"{octet.format(9)} % 256, {octet.format(13)} % 256)"
    )
    iban = "concat(substr(same, 5), left(canon, 2))"
    body = "concat(left(canon, 1), substr(same, 2, length(canon) - 2))"
    name = F.lit(None).cast("string")
    for script, parts in SYLLABLES.items():
        syllables = (
            f"array_join(transform(sequence(1, 2 + cast(attempt / 4 as int)), i -> element_at(array({_sql_list(parts)}), 1 + {pair} % {len(parts)})), '')"
        )
        for role, end in ENDINGS[script].items():
            name = F.when(F.col("kind") == f"name:{script}:{role}", F.concat(F.expr(syllables), F.lit(end))).otherwise(name)
    surrogate = (
        F.when(F.col("kind") == "email", F.expr(f"concat({owner}, 'example.', {ending})"))
        .when(F.col("kind") == "ip", F.expr(ip))
        .when(F.col("kind") == "card", F.expr(f"concat({body}, cast({_luhn(body)} as string))"))
        .when(F.col("kind") == "iban", F.expr(f"concat(left(canon, 2), lpad(cast(98 - {_mod97(iban)} * 100 % 97 as string), 2, '0'), substr(same, 5))"))
        .when(F.col("kind").isin("phone", "ssn"), F.expr(
            "concat(regexp_extract(canon, '^([+][0-9]+:)', 1), regexp_replace(regexp_replace(same, '^.*:', ''), "
            "if(regexp_replace(canon, '^.*:', '') LIKE '0%', '^$', '^0'), '9'))"))
        .otherwise(name)
    )
    return rows.withColumn("same", F.expr(same_shape)).select("kind", "canon", "attempt", surrogate.alias("surrogate"))


def surrogates(entities: DataFrame, key: str, rounds: int = 12) -> DataFrame:
    """(kind, canon, surrogate) for distinct entities (kind, canon).

    Within a kind no two entities share a surrogate and none is a real entity.
    Of those that collide one, picked by a keyed hash, keeps its draw and the
    others draw again. What ``rounds`` draws leave over, as when a kind has more
    entities than forms, gets a numbered mark of its kind.
    """
    todo = entities.withColumn("attempt", F.lit(0))
    done = None
    for _ in range(rounds):
        drawn = _drawn(todo, key)
        rank = F.struct(F.xxhash64(F.lit(key), "canon"), "canon")
        winner = drawn.groupBy("kind", "surrogate").agg(F.min_by("canon", rank).alias("winner"))
        taken = [entities.select("kind", F.col("canon").alias("surrogate"), F.lit(True).alias("real"))]
        if done is not None:
            taken.append(done.select("kind", "surrogate", F.lit(True).alias("real")))
        used = taken[0]
        for t in taken[1:]:
            used = used.unionAll(t)
        judged = settled(
            drawn.join(winner, ["kind", "surrogate"]).join(used.distinct(), ["kind", "surrogate"], "left")
            .select("kind", "canon", "attempt", "surrogate", ((F.col("canon") == F.col("winner")) & F.col("real").isNull()).alias("good"))
        )
        good = judged.where("good").select("kind", "canon", "surrogate")
        done = good if done is None else done.unionAll(good)
        todo = judged.where("NOT good").select("kind", "canon", (F.col("attempt") + 1).alias("attempt"))
        if todo.isEmpty():
            return done
    mark = F.concat(F.lit("["), F.col("kind"), F.lit(":"), F.sha2(F.concat(F.lit(key), "canon"), 256), F.lit("]"))
    return done.unionAll(todo.select("kind", "canon", mark.alias("surrogate")))


def _rendered(parts: DataFrame) -> DataFrame:
    """(mention, shown, names): each mention in its own format with the surrogate of its entity, and the words of a name with theirs."""
    digit_at = _digits("substr(mention, 1, i)")
    total = f"length({_digits('mention')})"
    # The k-th digit from the right is that of the surrogate; a country code before it stays.
    own = "regexp_replace(surrogate, '^[+][0-9]+:', '')"
    place = f"(length({digit_at}) - ({total} - length({own})))"
    digits = (
        f"array_join(transform(sequence(1, length(mention)), i -> if(substr(mention, i, 1) RLIKE '[0-9]' AND {place} > 0, "
        f"substr({own}, {place}, 1), substr(mention, i, 1))), '')"
    )
    spaced = (
        "array_join(transform(sequence(1, length(mention)), i -> if(substr(mention, i, 1) = ' ', ' ', "
        "substr(surrogate, length(replace(substr(mention, 1, i), ' ', '')), 1))), '')"
    )
    shown = F.expr(
        f"CASE WHEN surrogate LIKE '[%' THEN surrogate WHEN kind = 'email' THEN if(upper(mention) = mention, upper(surrogate), surrogate) "
        f"WHEN kind = 'iban' THEN {spaced} WHEN kind IN ('phone', 'card', 'ssn') THEN {digits} "
        f"WHEN kind = 'ip' THEN surrogate WHEN upper(word) = word THEN upper(surrogate) ELSE initcap(surrogate) END"
    )
    # At most two words per mention.
    words = parts.select("mention", "part", "kind", "word", shown.alias("shown")).groupBy("mention").agg(
        F.min("kind").alias("kind"), F.array_sort(F.collect_list(F.struct("part", "word", "shown"))).alias("words")
    )
    title = F.regexp_extract("mention", r"^[\p{L}-]+\.? +", 0)
    joined = F.array_join(F.transform("words", lambda w: w["shown"]), " ")
    is_name = F.startswith("kind", F.lit("name:"))
    names = F.when(is_name, F.filter("words", lambda w: F.length(w["word"]) > 2)).otherwise(F.array().cast("array<struct<part:int,word:string,shown:string>>"))
    return words.select("mention", F.when(is_name, F.concat(title, joined)).otherwise(joined).alias("shown"), names.alias("names"))


def replace_entities(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs``, personal data in the text replaced, with the number of replaced mentions ``__mentions``.

    Found are e-mail and IP addresses, card numbers (13 to 19 digits with a
    right check digit), account numbers, social security and phone numbers, and
    names after a form of address; words of such a name, of three letters or more,
    are replaced in the rest of the document too, also without it.
    Punctuation, spacing, case, country codes, lengths and check digits stay in
    form, private IP addresses private; one entity in several formats has one
    surrogate, so has a surname with or without a given name. Null texts, empty
    ones and those without mentions come back as they are; repeated rows are
    replaced alike. A column ``__mentions`` is replaced, others of any name stay.

    Texts with mentions are searched once and written, with what was found, to
    the shared folder; all further steps read that. Plans hold a digest of the
    key, not the key.
    """
    digest = hmac.new(key.encode(), b"surrogates", hashlib.sha256).hexdigest()
    names = [c for c in docs.columns if c != "__mentions"]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(text_col).alias("text"))
    searched = rows.withColumn("__found", mentions("text"))
    some = settled(searched.where(F.size("__found") > 0))
    some = settled(pieces(some, "text").withColumns({"a": F.xxhash64("text"), "b": F.xxhash64(F.lit("b"), "text")}).drop("__found"))
    named = some.select(F.explode("__pieces.mention").alias("mention")).where("mention IS NOT NULL").distinct()
    parts = settled(_kinds(named))
    entities = settled(parts.select("kind", "canon").distinct())
    mapped = settled(_rendered(parts.join(surrogates(entities, digest), ["kind", "canon"])))
    # The mentions of one text, whichever rows have it: bounded by the text.
    pairs = some.select("a", "b", F.explode("__pieces.mention").alias("mention")).distinct().join(mapped, "mention")
    maps = pairs.groupBy("a", "b").agg(
        F.map_from_entries(F.collect_list(F.struct("mention", "shown"))).alias("shown"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("names")))).alias("names"),
    )
    # Words of names go in the text between mentions; the longest first, so that none is part of another.
    gap = (
        "aggregate(array_sort(names, (x, y) -> length(y.word) - length(x.word)), p.gap, (g, w) -> "
        "regexp_replace(g, concat('(?<![\\\\p{L}\\\\p{N}])', w.word, '(?![\\\\p{L}\\\\p{N}])'), w.shown))"
    )
    filled = some.join(maps, ["a", "b"], "left").withColumn(
        "new",
        F.expr(
            f"array_join(transform(__pieces, p -> concat(if(size(names) > 0, {gap}, p.gap), "
            "coalesce(try_element_at(shown, p.mention), p.mention, ''))), '')"
        ),
    )
    # No map: none of the text's mentions is an entity.
    replaced = F.when(F.col("shown").isNull(), 0).otherwise(
        F.expr("size(filter(__pieces, p -> try_element_at(shown, p.mention) IS NOT NULL))")
    )
    same = [F.col("row")[c].alias(c) for c in names]
    new = [F.col("new").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in names]
    return searched.where(F.size("__found") == 0).select(*same, F.lit(0).alias("__mentions")).unionAll(
        filled.select(*new, replaced.alias("__mentions"))
    )
