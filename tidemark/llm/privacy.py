"""Personal data replaced by keyed surrogates, with DataFrame functions only.

Every distinct entity of the corpus gets one surrogate of its own: the same kind, the same shape, never that of another entity and never a real
entity of the corpus. Mentions of an entity in any format become mentions of its surrogate in that format. A full name is two entities, its
given name and its surname, so two people stay two people; a mail host is an entity of its own, so two hosts stay two hosts. A name that a document tells by a
title is replaced in that document without the title as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.spans import matches
from tidemark.session import materialize

# Titles that tell the gender.
MALE = r"(?:Mr\.?|Herr|Señor|Sr\.|Monsieur|M\.|Don|г-н)"
FEMALE = r"(?:Mrs\.?|Ms\.?|Miss|Frau|Señora|Sra\.|Madame|Mme\.?|Doña|г-жа)"
# Titles that do not.
NEUTRAL = r"(?:Dr\.|Prof\.)"
TITLE = rf"(?:(?:{MALE}|{FEMALE})(?: {NEUTRAL})*|{NEUTRAL}(?: {NEUTRAL})*)"
NAME = r"\p{Lu}[\p{L}'-]+"
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
# Kinds and their forms, in the order in which they are tried at a place. What a title or a long number begins with is looked at first.
FORMS = (
    ("email", r"(?<![\p{L}0-9._%+-])[\p{L}0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"),
    ("card", r"(?<![0-9-])[0-9]{4}(?:[ -]?[0-9]{4}){3}(?![0-9])"),
    ("ip", rf"(?<![0-9.]){OCTET}(?:\.{OCTET}){{3}}(?![0-9]|\.[0-9])"),
    ("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    ("phone", r"(?<![0-9+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])[0-9]{3}[ .-]?[0-9]{4}(?![0-9])|(?=[0-9]{10}(?![0-9]))(?<=(?i:tel|phone|fax|mobile)[.:]{0,2}\x20)[0-9]{10}"),
    ("name", rf"(?=[DFHMPSг])(?<![\p{{L}}]){TITLE} {NAME}(?: {NAME})?"),
)
PATTERN = "|".join(form for _, form in FORMS)
# A word that may be a name without a title, tried last and in documents that tell a name.
WORD = r"(?<![\p{L}0-9])\p{Lu}[\p{L}'-]*\p{L}(?![\p{L}0-9._%+'-]*@)"
LETTERS = {
    "[a-z]": "abcdefghijklmnopqrstuvwxyz",
    "[A-Z]": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "[а-яё]": "абвгдежзийклмнопрстуфхцчшщъыьэюя",
    "[А-ЯЁ]": "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ",
    "[0-9]": "0123456789",
    r"[\p{Ll}]": "abcdefghijklmnopqrstuvwxyz",
    r"[\p{Lu}]": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
}
ATTEMPTS = 40
# Draws in an entity's own shape before longer surrogates are drawn, longer by one with every draw up to LONGER.
ROOM = 8
LONGER = 10


def kind_of(value: Column) -> Column:
    return F.coalesce(*[F.when(value.rlike(f"^(?:{form})$"), F.lit(kind)) for kind, form in FORMS])


def surname(value: Column) -> Column:
    return F.regexp_extract(value, rf"({NAME})$", 1)


def given_name(value: Column) -> Column:
    return F.regexp_extract(value, rf" ({NAME}) {NAME}$", 1)


def gender(value: Column) -> Column:
    """f or m as the title tells, u if it does not."""
    return F.when(value.rlike(f"^{FEMALE} "), "f").when(value.rlike(f"^{MALE} "), "m").otherwise("u")


def host_of(entity: str) -> Column:
    return F.regexp_extract(entity, "@(.*)$", 1)


def check_sum(digits: str) -> str:
    """SQL for the sum, modulo ten, that is 0 for card numbers: every other digit from the last but one doubled, its digits added."""
    digit = f"cast(substr({digits}, i, 1) as int)"
    twice = f"if({digit} > 4, 2 * {digit} - 9, 2 * {digit})"
    return f"(aggregate(sequence(1, length({digits})), 0, (s, i) -> s + if((length({digits}) - i) % 2 = 1, {twice}, {digit})) % 10)"


def canonical(kind: Column, value: Column) -> Column:
    """What all mentions of an entity have in common: the address without case, the digits, the surname."""
    return (
        F.when(kind == "email", F.lower(value))
        .when(kind == "ip", value)
        .when(kind == "name", F.concat(gender(value), F.lit(" "), F.lower(surname(value))))
        .otherwise(F.regexp_replace(value, "[^0-9]", ""))
    )


def entities_of(kind: Column, value: Column) -> Column:
    """The entities of a mention as an array of (part, kind, entity): given name and surname of a full name, one of all others."""
    given = F.concat(gender(value), F.lit(" "), F.lower(given_name(value)))
    whole = F.struct(F.lit(0).alias("part"), kind.alias("kind"), canonical(kind, value).alias("entity"))
    first = F.struct(F.lit(0).alias("part"), F.lit("given").alias("kind"), given.alias("entity"))
    last = F.struct(F.lit(1).alias("part"), kind.alias("kind"), canonical(kind, value).alias("entity"))
    return F.when((kind == "name") & (given_name(value) != ""), F.array(first, last)).otherwise(F.array(whole))


def stream(key: str, attempt: int, *parts: str) -> str:
    """SQL for hex digits that follow from the key and the parts; as many as ``entity`` can need."""
    text = ", ".join(["'" + key.replace("\\", "\\\\").replace("'", "\\'") + "'", f"'{attempt}'", *parts])
    return f"array_join(transform(sequence(0, length(entity) div 32), b -> sha2(concat_ws('|', {text}, b), 512)), '')"


def draw(hexes: str, place: str, count: str) -> str:
    """SQL for a number below ``count`` from the four hex digits of ``place``."""
    return f"(cast(conv(substr({hexes}, 4 * ({place}) + 1, 4), 16, 10) as int) % {count})"


def reshaped(value: str, hexes: str) -> str:
    """SQL for ``value`` with every letter and digit replaced by one of its kind."""
    cases = " ".join(f"when c rlike '{form.replace(chr(92), chr(92) * 2)}' then substr('{letters}', 1 + {draw(hexes, 'i', str(len(letters)))}, 1)" for form, letters in LETTERS.items())
    return f"array_join(transform(filter(split({value}, ''), c -> c <> ''), (c, i) -> case {cases} else c end), '')"


def proposed(entities: DataFrame, key: str, attempt: int) -> DataFrame:
    """``entities`` (kind, entity, host: the surrogate host of an address) with the surrogate of one attempt, in canonical form."""
    address = "regexp_extract(entity, '^(.*)@(.*)[.]([^.]*)$', {})"
    data = entities.withColumn("own", F.expr(stream(key, attempt, "kind", "entity")))
    more = min(LONGER, max(0, attempt - ROOM + 1))
    letters = LETTERS["[a-z]"]
    tail = "".join(f", substr('{letters}', 1 + {draw('tail', str(n), str(len(letters)))}, 1)" for n in range(more))
    if more:
        data = data.withColumn("tail", F.expr("sha2(concat_ws('|', own, 'tail'), 512)"))
    email = f"concat({reshaped(address.format(1), 'own')}{tail}, '@', host)"
    site = "regexp_extract(entity, '^(.*)[.]([^.]*)$', {})"
    host = f"concat({reshaped(site.format(1), 'own')}{tail}, '.', {site.format(2)})"
    # A number that passes its check keeps passing, one that does not does not pass.
    front = "substr(drawn, 1, length(entity) - 1)"
    data = data.withColumn("drawn", F.when(F.col("kind") == "card", F.expr(reshaped("entity", "own"))))
    data = data.withColumn("front", F.expr(front)).withColumn("check", F.expr(f"(10 - {check_sum("concat(front, '0')")}) % 10"))
    card = f"concat(front, cast(if({check_sum('entity')} = 0, check, (check + 1 + {draw('own', '31', '9')}) % 10) as string))"
    octets = ", '.', ".join(f"cast({0 if more else 1} + {draw('own', str(n), '256' if more else '254')} as string)" for n in range(3))
    ip = f"concat(if(entity rlike '^(10|127)[.]', '10', cast(11 + {draw('own', '3', '112')} as string)), '.', {octets})"
    vowels, stops = "'aeiou'", "'bdfgklmnprstvz'"
    russian_vowels, russian_stops = "'аеиоу'", "'бвгдзклмнпрст'"

    def syllables(stop: str, vowel: str, count: int) -> str:
        return ", ".join(f"substr({stop}, 1 + {draw('own', str(2 * n), f'length({stop})')}, 1), substr({vowel}, 1 + {draw('own', str(2 * n + 1), '5')}, 1)" for n in range(count + more))

    def ending(stop: str, vowel: str) -> str:
        """A consonant for a man's given name, and an a behind it for a woman's."""
        return f"substr({stop}, 1 + {draw('own', '30', f'length({stop})')}, 1), if(entity like 'f %', substr({vowel}, 1, 1), '')"

    name = f"concat(substr(entity, 1, 2), if(entity rlike '[а-яё]', concat({syllables(russian_stops, russian_vowels, 4)}), concat({syllables(stops, vowels, 4)})))"
    given = (
        f"concat(substr(entity, 1, 2), if(entity rlike '[а-яё]', concat({syllables(russian_stops, russian_vowels, 3)}, {ending(russian_stops, russian_vowels)}), "
        f"concat({syllables(stops, vowels, 3)}, {ending(stops, vowels)})))"
    )
    # A number of more than ten digits keeps its country's.
    country = "greatest(0, length(entity) - 10)"
    phone = f"concat(substr(entity, 1, {country}), substr({reshaped('entity', 'own')}, 1 + {country}))"
    made = f"case kind when 'email' then {email} when 'host' then {host} when 'card' then {card} when 'ip' then {ip} when 'phone' then {phone} when 'name' then {name} when 'given' then {given} else {reshaped('entity', 'own')} end"
    return data.select("kind", "entity", "host", F.expr(made).alias("surrogate"))


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """A surrogate for every one of ``entities`` (kind, entity; distinct), no two alike within a kind, none a real entity.

    The hosts of addresses are settled first, as entities of a kind of their own; addresses of one host share its surrogate.
    Where several propose the same, the first by name keeps it; the others, and those that meet a real entity, draw anew. After ROOM draws
    addresses get longer local parts and names more syllables, so that no busy host or name runs out of room. Numbers have the length of
    their entity; only if ATTEMPTS draws in a row place none of those left, as where no number of that length is free, this ends in an error.
    """
    none = F.lit(None).cast("string").alias("host")
    mail = entities.where("kind = 'email'").select(F.lit("host").alias("kind"), host_of("entity").alias("entity"), none).distinct()
    hosts = _settle(materialize(mail), key).select(F.col("entity").alias("real_host"), F.col("surrogate").alias("host"))
    whole = entities.withColumn("real_host", F.when(F.col("kind") == "email", host_of("entity"))).join(hosts, "real_host", "left")
    return _settle(materialize(whole.select("kind", "entity", "host")), key)


def _settle(entities: DataFrame, key: str) -> DataFrame:
    settled, waiting, left, attempt, idle = None, entities, None, 0, 0
    while idle < ATTEMPTS:
        drawn = proposed(waiting, key, attempt)
        order = Window.partitionBy("kind", "surrogate").orderBy("entity")
        drawn = drawn.withColumn("first", F.row_number().over(order) == 1)
        real = entities.select("kind", F.col("entity").alias("surrogate"), F.lit(True).alias("real"))
        drawn = drawn.join(real, ["kind", "surrogate"], "left")
        if settled is not None:
            drawn = drawn.join(settled.select("kind", "surrogate", F.lit(True).alias("taken")), ["kind", "surrogate"], "left")
        else:
            drawn = drawn.withColumn("taken", F.lit(None).cast("boolean"))
        drawn = materialize(drawn.withColumn("good", F.col("first") & F.col("real").isNull() & F.col("taken").isNull()))
        done = drawn.where("good").select("kind", "entity", "surrogate")
        settled = done if settled is None else settled.unionByName(done)
        waiting = drawn.where("not good").select("kind", "entity", "host")
        before, left = left, waiting.count()
        if not left:
            return settled
        attempt, idle = attempt + 1, idle + 1 if left == before else 0
    raise ValueError("a kind of entity has no free surrogate")


def mention(kind: Column, value: Column, surrogate: Column) -> Column:
    """The surrogate in the format of the mention: its separators, its case, its title; of a full name, the part of that entity."""
    filled = F.expr(
        "array_join(transform(filter(split(value, ''), c -> c <> ''), (c, i) -> if(c rlike '[0-9]', "
        "substr(surrogate, 1 + length(regexp_replace(substr(value, 1, i), '[^0-9]', '')), 1), c)), '')"
    )
    title = F.regexp_extract(value, rf"^({TITLE} )", 1)
    name = F.initcap(F.substring(surrogate, 3, 100))
    loud = surname(value) == F.upper(surname(value))
    name = F.when(loud, F.upper(name)).otherwise(name)
    return (
        F.when(kind.isin("given", "name") & (title == ""), name)
        .when(kind == "given", F.concat(title, name, F.lit(" ")))
        .when(kind == "name", F.when(given_name(value) == "", F.concat(title, name)).otherwise(name))
        .when(kind == "ip", surrogate)
        .when((kind == "email") & (value == F.upper(value)), F.upper(surrogate))
        .when(kind == "email", surrogate)
        .otherwise(filled)
    )


def replace_private(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` (doc_id, text, more) with every entity in text replaced, and n_entities (long).

    Entities are e-mail addresses, card numbers, IPv4 addresses, social security and phone numbers, and names after a title. In a document that
    names somebody so, each word that is that given name or surname, as written there or in capitals, is a mention too; where two people of one
    document share the name, it means the first one. The same
    ``key`` gives the same surrogates for the same set of entities. Null and empty texts stay as they are with 0 entities; repeated rows become equal
    rows; no rows give none. A column named n_entities is replaced.
    """
    columns = [c for c in docs.columns if c != "n_entities"]
    docs = docs.select(*columns)
    text = F.col("text")
    named = text.rlike(dict(FORMS)["name"])
    wide = f"{PATTERN}|{WORD}"
    found = F.when(named, matches(text, wide)).otherwise(matches(text, PATTERN))
    row = F.concat_ws("|", F.col("doc_id").cast("string"), F.md5("text"))
    mentions = docs.where("text is not null").select(row.alias("_row"), F.posexplode(found).alias("place", "value"))
    word = F.when(F.col("value").rlike(f"^(?:{WORD})$"), "word")
    mentions = mentions.withColumn("kind", F.coalesce(kind_of(F.col("value")), word, F.lit("phone")))
    mentions = materialize(mentions.select("_row", "place", "value", F.inline(entities_of(F.col("kind"), F.col("value")))))
    told = mentions.where("kind <> 'word'")
    written = F.when(F.col("kind") == "given", given_name(F.col("value"))).otherwise(surname(F.col("value")))
    names = told.where("kind in ('given', 'name')").select("_row", F.explode(F.array_distinct(F.array(written, F.upper(written)))).alias("value"), "place", "part", F.col("kind").alias("its"), F.col("entity").alias("who"))
    names = names.groupBy("_row", "value").agg(F.min(F.struct("place", "part", "its", "who")).alias("first"))
    bare = mentions.where("kind = 'word'").join(names, ["_row", "value"], "left")
    bare = bare.select("_row", "place", "value", "part", F.coalesce("first.its", "kind").alias("kind"), F.coalesce("first.who", F.lit("")).alias("entity"))
    entities = materialize(told.select("kind", "entity").distinct())
    chosen = surrogates(entities, key).select("kind", "entity", "surrogate")
    known = F.col("surrogate").isNotNull()
    told = told.unionByName(bare.where("kind <> 'word'")).join(chosen, ["kind", "entity"])
    told = told.unionByName(bare.where("kind = 'word'").withColumn("surrogate", F.lit(None).cast("string")))
    told = told.withColumn("new", F.when(known, mention(F.col("kind"), F.col("value"), F.col("surrogate"))).otherwise(F.col("value")))
    lists = told.groupBy("_row").agg(F.collect_set(F.struct("place", "part", "new", known.alias("entity"))).alias("news"))
    joined = docs.withColumn("_row", row).join(lists, "_row", "left")
    gaps = F.when(named, F.split("text", wide, -1)).otherwise(F.split("text", PATTERN, -1))
    filled = F.transform(F.array_sort("news"), lambda n: F.concat(F.when(n["part"] == 0, F.get("_gaps", n["place"])).otherwise(""), n["new"]))
    text = F.concat(F.array_join(filled, ""), F.element_at("_gaps", -1))
    joined = joined.withColumn("_gaps", F.when(F.col("news").isNotNull(), gaps))
    rest = [F.when(F.col("news").isNull(), F.col("text")).otherwise(text).alias("text") if c == "text" else F.col(c) for c in columns]
    return joined.select(*rest, F.coalesce(F.size(F.filter("news", lambda n: (n["part"] == 0) & n["entity"])), F.lit(0)).cast("long").alias("n_entities"))
