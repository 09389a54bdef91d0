"""Personal data in texts, and terms that give protected entities away, with DataFrame functions only.

Patterns find e-mail addresses, IP addresses, card and phone numbers; these are the protected entities. A term (a word
of four letters or more) discloses an entity by how much seeing it tells about the entity: the pointwise mutual
information of the two, estimated from how often they meet in the corpus's lines, against all the information that
the entity carries:  PMI(e; t) >= share * IC(e),  IC(e) = log(N / n(e)). Equal lines count once, so copies prove
nothing, and a term must meet an entity in ``support`` different lines. Occurrences of such terms, wherever they are,
become spans of kind `term`; sanitised text has spans generalised to their kind, and terms that tell all, removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed, likely
from tidemark.llm.ranks import kept

# The base patterns, leftmost and non-overlapping. Possessive groups and the look-behinds change no match;
# they keep the time linear and the stack flat in long runs.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+",
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Cheap tests that every text with such a match passes.
GATES = {
    "email": lambda t: F.contains(t, F.lit("@")),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9](?:[ -]?[0-9]){13}"),
    "phone": lambda t: F.contains(t, F.lit("+")),
}
TERM = r"\p{L}{4,}"
#: Spans of a text that are built at a time.
BLOCK = 64


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _ip_ok(m: Column) -> Column:
    part = lambda p: F.regexp_replace(p, "^0+", "")
    return F.forall(F.split(m, r"\."), lambda p: (F.length(part(p)) <= 3) & (F.coalesce(part(p).try_cast("int"), F.lit(0)) <= 255))


def _card_ok(m: Column) -> Column:
    d = _digits(m)
    n = F.length(d)
    doubled = lambda v: F.when(v > 4, v * 2 - 9).otherwise(v * 2)
    padded = F.lpad(d, 20, "0")
    total = sum((doubled(F.substring(padded, 20 - i, 1).cast("int")) if i % 2 else F.substring(padded, 20 - i, 1).cast("int") for i in range(20)), F.lit(0))
    return n.between(14, 19) & (total % 10 == 0)


def _phone_ok(m: Column) -> Column:
    return F.length(_digits(m)).between(10, 15)


VALID = {"email": lambda m: F.lit(True), "ip": _ip_ok, "card": _card_ok, "phone": _phone_ok}


def found(text: Column, kind: str) -> Column:
    """An array of the kind's spans: start, no (the kind's number), end, value; in code points, end exclusive."""
    pattern = F.lit(PATTERNS[kind])
    matches, gaps = F.regexp_extract_all(text, pattern, 0), F.split(text, PATTERNS[kind], -1)
    lengths = lambda part: F.transform(part, lambda x: F.length(x))
    steps = F.zip_with(lengths(F.slice(gaps, 1, F.size(matches))), lengths(matches), lambda g, m: F.struct(g.alias("g"), m.alias("m")))
    nothing = F.expr("cast(array() as array<struct<start:int,no:int,end:int>>)")
    no = KINDS.index(kind)

    def walk(acc, s):
        start = acc["at"] + s["g"]
        own = F.struct(start.alias("start"), F.lit(no).alias("no"), (start + s["m"]).alias("end"))
        return F.struct((start + s["m"]).alias("at"), F.concat(acc["out"], F.array(own)).alias("out"))

    # An array grows by being copied, so spans are built in blocks; where a block begins is summed over the blocks before.
    once = lambda value, then: F.transform(F.array(value), then)[0]  # noqa: E731  evaluated once, however often it is used
    cut = lambda st: F.transform(F.sequence(F.lit(0), (F.size(st) / BLOCK).cast("int")), lambda b: F.slice(st, b * BLOCK + 1, F.lit(BLOCK)))
    width = lambda block: F.aggregate(block, F.lit(0), lambda n, s: n + s["g"] + s["m"])
    upto = lambda widths, b: F.aggregate(F.slice(widths, F.lit(1), b), F.lit(0), lambda n, w: n + w)
    spread = lambda widths, blocks: F.transform(blocks, lambda block, b: F.aggregate(block, F.struct(upto(widths, b).alias("at"), nothing.alias("out")), walk, lambda acc: acc["out"]))
    spans = once(steps, lambda st: once(cut(st), lambda blocks: once(F.transform(blocks, width), lambda widths: F.flatten(spread(widths, blocks)))))
    both = F.zip_with(spans, matches, lambda s, m: F.struct(s["start"].alias("start"), s["no"].alias("no"), s["end"].alias("end"), m.alias("value")))
    empty = F.expr("cast(array() as array<struct<start:int,no:int,end:int,value:string>>)")
    return F.when(GATES[kind](text), F.filter(both, lambda s: VALID[kind](s["value"]))).otherwise(empty)


def base_spans(docs: DataFrame) -> DataFrame:
    """The columns given and ``base``: all valid spans by start, then kind. Null text counts as empty."""
    text = F.coalesce("text", F.lit(""))
    return docs.withColumn("base", F.sort_array(F.concat(*(found(text, k) for k in KINDS))))


def _entities(lines: DataFrame) -> DataFrame:
    """entity and line_hash of every protected value in the lines; e-mail in lower case, numbers by their digits."""
    spans = lines.select("line_hash", F.explode(F.concat(*(found(F.col("line"), k) for k in KINDS))).alias("s"))
    value = F.when(F.col("s.no") == 0, F.lower("s.value")).when(F.col("s.no") == 1, F.col("s.value")).otherwise(_digits(F.col("s.value")))
    return spans.select(F.concat_ws(":", F.col("s.no").cast("string"), value).alias("entity"), "line_hash").distinct()


def disclosing_terms(docs: DataFrame, share: float = 0.8, support: int = 2) -> DataFrame:
    """term, disclosed: terms whose information on some entity is at least ``share`` of the entity's own, and the
    largest such share. Counts are over the different lines of all documents."""
    lines = docs.where("text is not null").select(F.explode(F.split("text", "\n", -1)).alias("line"))
    some = F.lit(False)
    for k in KINDS:
        some = some | GATES[k](F.col("line"))
    hashed = lines.select(F.xxhash64("line").alias("line_hash"), "line")
    # Lines that may hold an entity, once each; from here on they go by their hash.
    holding = kept(hashed.where(some).dropDuplicates(["line_hash"]), "holding")
    entities = kept(_entities(holding), "entities")
    bare = F.col("line")
    for k in KINDS:
        bare = F.regexp_replace(bare, PATTERNS[k], " ")
    words = lambda c: F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit(TERM), 0))
    around = holding.join(entities.select("line_hash").distinct(), "line_hash", "left_semi").select("line_hash", F.explode(words(bare)).alias("term"))
    met = entities.join(around, "line_hash").groupBy("entity", "term").agg(F.count("*").alias("n_et"))
    met = kept(met.where(F.col("n_et") >= support), "met")
    n_e = entities.groupBy("entity").agg(F.count("*").alias("n_e"))
    terms = kept(met.select("term").distinct(), "terms")
    # A term's lines: all of them, less what repeated lines count too much. So no row per line and word is moved.
    copies = kept(hashed.groupBy("line_hash").agg(F.count("*").alias("copies")), "line-copies")
    repeats = copies.where("copies > 1")
    repeated = likely(hashed, "line_hash", repeats.select("line_hash")).join(repeats, "line_hash").dropDuplicates(["line_hash"])
    counted = lambda rows, n: likely(rows.select(F.explode(words(F.col("line"))).alias("term"), n.alias("n")), "term", terms)
    every = counted(hashed, F.lit(1).cast("bigint")).unionByName(counted(repeated, F.lit(1) - F.col("copies")))
    n_t = every.groupBy("term").agg(F.sum("n").alias("n_t"))
    all_lines = copies.agg(F.count("*").alias("n"))
    pmi = F.log(F.col("n_et") * F.col("n") / (F.col("n_e") * F.col("n_t")))
    # An entity that stands in every line carries no information that a term could tell.
    told = met.join(n_e, "entity").join(n_t, "term").join(F.broadcast(all_lines)).withColumn("told", F.try_divide(pmi, F.log(F.col("n") / F.col("n_e"))))
    return told.where(F.col("told") >= share).groupBy("term").agg(F.max("told").alias("disclosed"))


def term_spans(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """doc_id, _text (a hash of the text) and ``terms``: the spans of all occurrences of the terms, by start."""
    named = docs.where("text is not null").select("doc_id", F.xxhash64("text").alias("_text"), "text")
    tokens = named.select("doc_id", "_text", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(TERM), 0))).alias("term"))
    holding = likely(tokens, "term", terms.select("term")).join(terms.select("term"), "term").select("doc_id", "_text").distinct()
    texts = named.join(holding, [named.doc_id.eqNullSafe(holding.doc_id), named["_text"] == holding["_text"]], "left_semi").dropDuplicates(["doc_id", "_text"])
    cut = F.arrays_zip(F.split("text", TERM, -1).alias("gap"), F.regexp_extract_all("text", F.lit(TERM), 0).alias("word"))
    rows = texts.select("doc_id", "_text", F.posexplode(cut).alias("i", "x")).select("doc_id", "_text", "i", F.length("x.gap").alias("g"), F.col("x.word").alias("word"))
    order = Window.partitionBy("doc_id", "_text").orderBy("i")  # one document's words
    placed = rows.withColumn("end", F.sum(F.col("g") + F.coalesce(F.length("word"), F.lit(0))).over(order)).withColumn("term", F.lower("word"))
    hits = placed.join(terms, "term").select("doc_id", "_text", F.struct((F.col("end") - F.length("word")).cast("int").alias("start"), F.lit(len(KINDS)).alias("no"), F.col("end").cast("int").alias("end"), "disclosed").alias("s"))
    return hits.groupBy("doc_id", "_text").agg(F.sort_array(F.collect_list("s")).alias("terms"))


def _joined(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in (*KINDS, "term")))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["no"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def with_spans(docs: DataFrame, share: float = 0.8, support: int = 2) -> DataFrame:
    """doc_id, text, base and terms (arrays of spans) of every row; rows without terms have none."""
    based = base_spans(docs.select("doc_id", "text")).withColumn("_text", F.xxhash64("text"))
    terms = checkpointed(disclosing_terms(docs, share, support))
    hits = term_spans(docs, terms)
    hits = hits.select(F.col("doc_id").alias("_id"), F.col("_text").alias("_hash"), "terms")
    none = F.expr("cast(array() as array<struct<start:int,no:int,end:int,disclosed:double>>)")
    joined = based.join(hits, based["doc_id"].eqNullSafe(hits["_id"]) & (based["_text"] == hits["_hash"]), "left")
    return joined.select("doc_id", "text", "base", F.coalesce("terms", none).alias("terms"))


def find(docs: DataFrame, share: float = 0.8, support: int = 2) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_term; one row per row.

    spans: `kind:start:end` of base spans and disclosing terms by start, then kind, joined by commas; base_sha256 is
    over the base ones alone. Null and empty texts have no spans (the digest is that of the empty text). Other columns
    are not looked at; no rows give no rows.
    """
    rows = with_spans(docs, share, support)
    count = lambda k: F.size(F.filter("base", lambda s: s["no"] == KINDS.index(k))).cast("long").alias(f"n_{k}")
    plain = lambda c: F.transform(c, lambda s: F.struct(s["start"].alias("start"), s["no"].alias("no"), s["end"].alias("end")))
    every = F.sort_array(F.concat(plain("base"), plain("terms")))
    return rows.select("doc_id", *(count(k) for k in KINDS), F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(every).alias("spans"), F.size("terms").cast("long").alias("n_term"))


def sanitise(docs: DataFrame, share: float = 0.8, support: int = 2, removed: float = 0.95) -> DataFrame:
    """doc_id and text with spans generalised to `[kind]`; terms that tell at least ``removed`` of an entity go.

    Of overlapping spans the first stands for all. Null stays null.
    """
    rows = with_spans(docs, share, support)
    names = F.array(*(F.lit(f"[{k}]") for k in (*KINDS, "term")))
    mark = lambda s, told: F.struct(s["start"].alias("start"), s["no"].alias("no"), s["end"].alias("end"), F.when(told >= removed, F.lit("")).otherwise(F.element_at(names, s["no"] + 1)).alias("mark"))
    every = F.sort_array(F.concat(F.transform("base", lambda s: mark(s, F.lit(0.0))), F.transform("terms", lambda s: mark(s, s["disclosed"]))))

    def step(acc, s):
        ahead = F.expr("text").substr(acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        taken = F.when(s["start"] >= acc["at"], F.concat(acc["out"], ahead, s["mark"])).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), taken.alias("out"))

    end = F.aggregate(every, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step)
    rest = F.col("text").substr(F.col("done.at") + 1, F.length("text"))
    return rows.withColumn("done", end).select("doc_id", F.concat("done.out", rest).alias("text"))
