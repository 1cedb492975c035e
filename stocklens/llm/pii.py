"""Personal data, and the terms that give it away, by information-theoretic sanitisation.

Base spans are e-mail addresses, IP addresses, card numbers and phone numbers; these are the
protected entities. A term (a word of any case, two characters at least, outside all base spans)
discloses an entity as far as the corpus shows that the two go together (Sanchez and Batet's
C-sanitisation):

    PMI(e, t) = log2(n_et * N / (n_e * n_t))      IC(e) = log2(N / n_e)
    disclosure = PMI / IC, at most 1 (the term occurs only with the entity)

N counts the distinct texts of the corpus, n_t those that hold the term anywhere (in an address too), n_e those that
hold the entity, n_et those that hold both. Three ties between entity and term are weighed:

* *near*: a capitalised term of four characters or more is within ``REACH`` code points of the literal
  entity, in ``min_texts`` distinct texts at least; one text alone shows no such tie, and copies are
  one text. Other words are not tied to one address, as any word can be rare;
* *part*: the term is a part of an e-mail address (a piece of its local part or domain, but the last
  label), or a capitalised word beside such a term ("Johannes Brandt" of j.brandt@...), anywhere in
  a text with that address. The datum itself shows the tie, so one text is enough;
* *kind*: the term is within ``REACH`` code points of any entity of a kind (e is the kind). As any
  word may be there by chance, the texts must give ``least_bits`` bits of evidence (the log-likelihood
  ratio of the term's rate of such texts against the rate of all) and PMI must be a bit at least.

From ``generalise_at`` on, a term is replaced by its class in the texts that hold the tie, from
``remove_at`` on it is removed. A word that many texts hold has a low PMI and stays, whatever
addresses contain it. Near ties take the reach and not the whole text, or in a corpus whose every
text of one language ends in an address all words of that language would go.

Everything is DataFrame functions. No base match holds a line end or spans a whole text, and each
pattern starts at most once in a run of its characters, so long texts take time in proportion.

Defined results: a null text is empty and has no spans; a text without digit and "@" is passed
through untouched; equal texts get equal spans; an entity in every text discloses nothing (IC 0);
a text without words has no terms; an empty table gives no rows; further columns are kept and may
have any name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import settle, table, text_column

KINDS = ("email", "ip", "card", "phone", "removed", "generalised")
#: Possessive forms of the contract's patterns: what follows a run is never inside its class, so
#: they match the same strings without going back, and a failed run is not tried again.
PATTERNS = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9](?:[ -]?[0-9])++",
    r"\+[0-9][ ().0-9-]+[0-9]",
)
LETTER = r"[\p{L}\p{M}\p{N}]"
TERM = rf"(?<!{LETTER})\p{{L}}{LETTER}++"
#: Capitalised words in a row, with single spaces.
NAME = rf"(?<!{LETTER})\p{{Lu}}{LETTER}*+(?: \p{{Lu}}{LETTER}*+)++"
TITLE = rf"^\p{{Lu}}{LETTER}{{3,}}"
LEAST_PIECE = 3  # shorter pieces of an address are initials and country codes
REACH = 120
TAGS = ("[EMAIL]", "[IP]", "[CARD]", "[PHONE]", "", "[NAME]")
SPAN = "array<struct<start:int,kind:int,end:int>>"


def located(text: Column, pattern: Column, fits: Callable[[Column], Column] | None = None) -> Column:
    """start, end and found of each match that ``fits``, leftmost first, in code points. Only these
    are gathered, so that a text full of other numbers takes time in proportion."""
    fits = fits or (lambda found: F.lit(True))
    pieces = F.zip_with(
        F.split(text, pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0)),
        lambda gap, found: F.struct(F.length(gap).alias("gap"), found.alias("found")),
    )

    def step(so_far: Column, piece: Column) -> Column:
        start = so_far["at"] + F.coalesce(piece["gap"], F.lit(0))
        end = start + F.coalesce(F.length(piece["found"]), F.lit(0))
        one = F.array(F.struct(start.alias("start"), end.alias("end"), piece["found"].alias("found")))
        return F.struct(
            end.alias("at"),
            F.when(piece["found"].isNull() | ~fits(piece["found"]), so_far["out"]).otherwise(F.concat(so_far["out"], one)).alias("out"),
        )

    nothing = F.array().cast("array<struct<start:int,end:int,found:string>>")
    start = F.struct(F.lit(0).alias("at"), nothing.alias("out"))
    return F.aggregate(pieces, start, step, lambda s: s["out"])


def passes(kind: int, found: Column) -> Column:
    digits = F.regexp_replace(found, "[^0-9]", "")
    if kind == 1:
        small = "^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})$"
        return F.forall(F.split(found, r"\."), lambda part: part.rlike(small))
    if kind == 2:
        return F.length(digits).between(14, 19) & F.call_function("luhn_check", digits)
    if kind == 3:
        return F.length(digits).between(10, 15)
    return F.lit(True)


def as_spans(matches: Column, kind: int) -> Column:
    return F.transform(
        matches,
        lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end")),
    )


def spans_of_kind(text: Column, kind: int) -> Column:
    matches = located(text, F.lit(PATTERNS[kind]), lambda found: passes(kind, found))
    needed = {0: F.contains(text, F.lit("@")), 3: F.contains(text, F.lit("+"))}.get(kind, F.lit(True))
    spans = as_spans(matches, kind)
    return F.when(needed, spans).otherwise(F.array().cast(SPAN))


def base_spans(text: Column) -> Column:
    """Spans of the four base kinds by start, then kind."""
    return F.array_sort(F.concat(*[spans_of_kind(text, kind) for kind in range(len(PATTERNS))]))


def term_spans(text: Column, terms: Column, kind: int, taken: Column) -> Column:
    """Spans of the whole words ``terms`` (letters and digits only) that touch no base span."""
    pattern = F.concat(F.lit(f"(?<!{LETTER})(?:"), F.array_join(terms, "|"), F.lit(f")(?!{LETTER})"))
    found = F.filter(
        located(text, pattern),
        lambda m: ~F.exists(taken, lambda s: (s["start"] < m["end"]) & (m["start"] < s["end"])),
    )
    spans = as_spans(found, kind)
    return F.when(F.size(terms) > 0, spans).otherwise(F.array().cast(SPAN))


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ","
    )


def cleaned(text: Column, spans: Column) -> Column:
    """The text with each stretch of spans replaced by the tag of its first span."""
    tags = F.array(*[F.lit(t) for t in TAGS])

    def step(so_far: Column, s: Column) -> Column:
        piece = F.concat(
            F.substring(text, so_far["at"] + 1, s["start"] - so_far["at"]), tags[s["kind"]]
        )
        return F.struct(
            F.greatest(so_far["at"], s["end"]).alias("at"),
            F.when(s["start"] >= so_far["at"], F.concat(so_far["out"], F.array(piece)))
            .otherwise(so_far["out"]).alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    last = lambda s: F.concat(F.array_join(s["out"], ""), F.substring(text, s["at"] + 1, F.length(text)))
    return F.aggregate(spans, start, step, last)


def masked(text: Column, spans: Column) -> Column:
    """The text with blanks in place of the spans; all other places stay where they are."""

    def step(so_far: Column, s: Column) -> Column:
        at = so_far["at"]
        gap = F.substring(text, at + 1, F.greatest(s["start"] - at, F.lit(0)))
        blanks = F.repeat(F.lit(" "), F.greatest(s["end"] - F.greatest(at, s["start"]), F.lit(0)))
        out = F.concat(so_far["out"], F.array(F.concat(gap, blanks)))
        return F.struct(F.greatest(at, s["end"]).alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    last = lambda s: F.concat(F.array_join(s["out"], ""), F.substring(text, s["at"] + 1, F.length(text)))
    return F.aggregate(spans, start, step, last)


def near_terms(text: Column, span: Column) -> Column:
    """Terms within REACH code points of the span; words cut by the reach are left out."""
    before = F.substring(text, F.greatest(span["start"] - REACH, F.lit(0)) + 1, F.least(span["start"], F.lit(REACH)))
    before = F.when(span["start"] > REACH, F.regexp_replace(before, r"^\S+", "")).otherwise(before)
    after = F.substring(text, span["end"] + 1, F.lit(REACH))
    after = F.when(F.length(text) > span["end"] + REACH, F.regexp_replace(after, r"\S+$", "")).otherwise(after)
    return words_of(F.concat(before, F.lit(" "), after))


def words_of(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)))


def hashed(text: Column) -> Column:
    """Sixteen bytes that stand for a text."""
    return F.unhex(F.md5(text))


def datum(text: Column, span: Column) -> Column:
    return F.lower(F.substring(text, span["start"] + 1, span["end"] - span["start"]))


def address_pieces(found: Column) -> Column:
    """Pieces of a lower-case address that can be words: local part and domain, but the last label."""
    pieces = F.split(F.regexp_replace(found, r"\.[^.]*$", ""), "[^a-z0-9]+")
    return F.filter(F.array_distinct(pieces), lambda p: (F.length(p) >= LEAST_PIECE) & p.rlike("[a-z]"))


def beside(text: Column) -> Column:
    """piece (lower case) and term of each word, and of both sides of two capitalised words in a row."""
    tie = lambda a, b: F.struct(F.lower(a).alias("piece"), b.alias("term"))

    def neighbours(name: Column) -> Column:
        words = F.split(name, " ")
        first, second = F.slice(words, 1, F.size(words) - 1), F.slice(words, 2, F.size(words))
        return F.concat(F.zip_with(first, second, tie), F.zip_with(second, first, tie))

    names = F.transform(F.regexp_extract_all(text, F.lit(NAME), F.lit(0)), neighbours)
    return F.array_distinct(F.concat(F.transform(words_of(text), lambda w: tie(w, w)), F.flatten(names)))


def texts_with_entities(docs: DataFrame, text: str) -> DataFrame:
    """One row for each distinct text with a base span: text_id, its entities with the words near
    them, the pieces of its addresses and what stands beside such pieces. Only these texts are shuffled."""
    t, s = F.col("t"), F.col("base")
    rows = (
        docs.select(text_column(docs, text).alias("t"))
        .where(t.rlike("[0-9@]"))
        .withColumn("base", base_spans(t))
        .where(F.size("base") > 0)
        .withColumn("text_id", hashed(t))
        .dropDuplicates(["text_id"])
        .withColumn("rest", masked(t, s))
    )
    entity = lambda m: hashed(F.concat_ws(":", m["kind"], datum(t, m)))
    found = F.transform(
        s,
        lambda m: F.struct(m["kind"].alias("kind"), entity(m).alias("entity"), near_terms(F.col("rest"), m).alias("near")),
    )
    mails = F.filter(s, lambda m: m["kind"] == 0)
    pieces = F.transform(
        mails, lambda m: F.struct(entity(m).alias("entity"), address_pieces(datum(t, m)).alias("pieces"))
    )
    ties = F.when(F.size(mails) > 0, beside(F.col("rest")))
    return rows.select(
        "text_id", found.alias("found"), F.array_distinct(pieces).alias("addresses"), ties.alias("beside")
    )


def texts_by_term(docs: DataFrame, text: str) -> DataFrame:
    """term and n_t, the distinct texts that hold it; the null term counts all texts. Texts are made
    distinct before they are cut into words, and each task sums its words before they are shuffled."""
    texts = docs.select(text_column(docs, text).alias("t")).withColumn("text_id", hashed(F.col("t")))
    terms = F.concat(words_of(F.col("t")), F.array(F.lit(None).cast("string")))
    return (
        texts.dropDuplicates(["text_id"]).select(F.explode(terms).alias("term"))
        .groupBy("term").agg(F.count("*").alias("n_t"))
    )


def evidence(n_et: Column, n_t: Column, rate: Column) -> Column:
    """Bits by which n_et of n_t texts speak against the given rate."""
    own = n_et / n_t
    rest = F.when(own < 1, (n_t - n_et) * F.log2((1 - own) / (1 - rate))).otherwise(0.0)
    return n_et * F.log2(own / rate) + rest


def disclosing_terms(
    docs: DataFrame, text: str = "text", remove_at: float = 0.9, generalise_at: float = 0.6,
    min_texts: int = 2, least_bits: float = 20.0,
) -> DataFrame:
    """text_id (the text's hash), removed and generalised: the terms to take from that text."""
    corpus = settle(texts_with_entities(docs, text), "texts")
    counts = settle(texts_by_term(docs, text), "held")
    held = counts.where(F.col("term").isNotNull())
    total = next((r[0] for r in counts.where(F.col("term").isNull()).select("n_t").collect()), 0)
    found = corpus.select("text_id", F.explode("found").alias("f")).select("text_id", "f.*")
    entities = settle(found.groupBy("entity").agg(F.count_distinct("text_id").alias("n_e")), "entities")
    kinds = found.groupBy("kind").agg(F.count_distinct("text_id").alias("n_e"))
    near = settle(
        found.select("text_id", "kind", "entity", F.explode("near").alias("term")).distinct(), "near"
    )
    addresses = corpus.select("text_id", F.explode("addresses").alias("a")).select(
        "text_id", "a.entity", F.explode("a.pieces").alias("piece")
    )
    words = corpus.where(F.size("addresses") > 0).select("text_id", F.inline("beside"))
    parts = addresses.join(words, ["text_id", "piece"]).select("text_id", "entity", "term")
    ties = settle(
        near.where(F.col("term").rlike(TITLE)).select("text_id", "entity", "term", F.lit(False).alias("part"))
        .union(parts.select("text_id", "entity", "term", F.lit(True)))
        .groupBy("text_id", "entity", "term").agg(F.max("part").alias("part")),
        "ties",
    )
    ratio = lambda top, bottom: F.log2(top.cast("double") / bottom.cast("double"))
    told = ratio(F.lit(total), F.col("n_e"))
    shared = ratio(F.col("n_et") * F.lit(total), F.col("n_e") * F.col("n_t"))
    disclosure = F.when(told > 0, shared / told).otherwise(0.0)
    gone = (disclosure >= remove_at).alias("gone")
    pairs = (
        ties.groupBy("entity", "term").agg(F.count("*").alias("n_et"), F.max("part").alias("part"))
        .where((F.col("n_et") >= min_texts) | F.col("part"))
    )
    graded = settle(
        pairs.join(entities, "entity").join(held, "term").where(disclosure >= generalise_at)
        .select("entity", "term", gone),
        "graded",
    )
    by_kind = near.select("text_id", "kind", "term").distinct()
    sure = evidence(F.col("n_et"), F.col("n_t"), F.col("n_e") / F.lit(total)) >= least_bits
    graded_kinds = settle(
        by_kind.groupBy("kind", "term").agg(F.count("*").alias("n_et"))
        .join(kinds, "kind").join(held, "term")
        .where((told > 0) & (shared >= 1) & (disclosure >= generalise_at) & sure)
        .select("kind", "term", gone),
        "graded-kinds",
    )
    return (
        ties.join(graded, ["entity", "term"]).select("text_id", "term", "gone")
        .union(by_kind.join(graded_kinds, ["kind", "term"]).select("text_id", "term", "gone"))
        .groupBy("text_id", "term").agg(F.max("gone").alias("gone"))
        .groupBy("text_id").agg(
            F.array_sort(F.collect_list(F.when(F.col("gone"), F.col("term")))).alias("removed"),
            F.array_sort(F.collect_list(F.when(~F.col("gone"), F.col("term")))).alias("generalised"),
        )
    )


def with_spans(docs: DataFrame, text: str = "text", **limits: float) -> DataFrame:
    """``d`` (struct of all columns of ``docs``), ``t`` (its text), ``base`` and ``spans``."""
    told = settle(disclosing_terms(docs, text, **limits), "told")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("d"), text_column(docs, text).alias("t"))
    none = F.array().cast(SPAN)
    possible = F.col("t").rlike("[0-9@]")
    plain = rows.where(~possible).select("d", "t", none.alias("base"), none.alias("spans"))
    found = (
        rows.where(possible)
        .withColumn("base", base_spans(F.col("t")))
        .withColumn("text_id", hashed(F.col("t")))
        .join(told, "text_id", "left")
    )
    extra = [
        F.when(F.col(c).isNull(), none).otherwise(term_spans(F.col("t"), F.col(c), KINDS.index(c), F.col("base")))
        for c in KINDS[4:]
    ]
    return plain.union(found.select("d", "t", "base", F.array_sort(F.concat("base", *extra)).alias("spans")))


def sanitise(docs: DataFrame, text: str = "text", **limits: float) -> DataFrame:
    """``docs`` with the text cleaned; all columns stay, in their order."""
    shown = cleaned(F.col("t"), F.col("spans"))
    clean = F.when(F.size("spans") > 0, shown).otherwise(F.col(f"d.`{text}`"))
    return with_spans(docs, text, **limits).select(
        *(clean.alias(c) if c == text else F.col(f"d.`{c}`").alias(c) for c in docs.columns)
    )


def op6_information_sanitised(spark: SparkSession, sf_dir: str) -> DataFrame:
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return with_spans(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "d.doc_id",
        *(count(k).alias(f"n_{name}") for k, name in enumerate(KINDS[:4])),
        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"),
    )
