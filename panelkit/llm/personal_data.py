"""Personal data: exact patterns, and terms that give protected entities away.

The patterns find addresses and numbers with their places. A protected entity is then one such
value. For every term of the documents that hold an entity, wherever it stands in them, the corpus
tells how much it discloses: the pointwise mutual information of term and entity,
log2(N * n(entity, term) / (n(entity) * n(term))), divided by the information of the entity,
log2(N / n(entity)). All counts are numbers of documents. A term is a run of letters of any script
outside addresses. A term with a share at or above the threshold gives the entity away, and each
of its places in a document that holds the entity becomes a span of kind ``term``: from ``REMOVE``
on it is to be removed, below that generalised. What is seen in fewer than ``SUPPORT`` different
texts is no evidence and left alone.

Equal texts are looked at once, with the number of their rows as weight. Texts are stored, and
travel, only where they hold a match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.llm.common import once, whole_text
from panelkit.session import materialise

#: Kinds in the order of results, and their patterns. Quantifiers are possessive and
#: matches start at the start of a run of their characters (or where the last match ended): the
#: same matches as with plain quantifiers, in time linear in the text.
PATTERNS = (
    (
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    ),
    ("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    ("card", r"[0-9](?:[\x20-]?[0-9]){15,}+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)
NEEDS = {"email": "@", "ip": ".", "phone": "+"}  # a character that every match holds
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
TERM = r"\p{L}{4,}"
SUPPORT = 2
GENERALISE = 0.8
REMOVE = 0.95


def _luhn(digits: Column) -> Column:
    def digit(i: Column) -> Column:
        value = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int")
        doubled = F.when(value > 4, 2 * value - 9).otherwise(2 * value)
        return F.when(i % 2 == 1, doubled).otherwise(value)

    total = F.aggregate(
        F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda sum_, i: sum_ + digit(i)
    )
    return total % 10 == 0


def _accepted() -> Column:
    digits = F.regexp_replace("value", "[^0-9]", "")
    return (
        F.when(F.col("kind") == 1, F.col("value").rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"))
        .when(F.col("kind") == 2, F.length(digits).between(16, 19) & _luhn(digits))
        .when(F.col("kind") == 3, F.length(digits).between(8, 15))
        .otherwise(True)
    )


def _pieces(text: Column) -> Column:
    """All matches of all kinds, in order, each with the length of the text since the last one.

    One more entry per kind, without a match, has the length of the text after the last one.
    """

    def of(kind: int, pattern: str, need: str | None) -> Column:
        def cut(found: Column) -> Column:
            return F.zip_with(
                F.split(text, pattern),
                found,
                lambda gap, value: F.struct(
                    F.lit(kind).alias("kind"),
                    F.length(gap).cast("long").alias("gap"),
                    value.alias("value"),
                ),
            )

        found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        if need:
            found = F.when(F.contains(text, F.lit(need)), found)
        return once(found, lambda x: F.when(F.size(x) > 0, cut(x)))

    empty = F.array().cast("array<struct<kind:int,gap:bigint,value:string>>")
    return F.concat(
        *(
            F.coalesce(of(kind, pattern, NEEDS.get(name)), empty)
            for kind, (name, pattern) in enumerate(PATTERNS)
        )
    )


def find_pieces(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """row, id, content (digest of the text), and one row per match or one without: stored.

    The first row of a document with a match also has its text.
    """
    found = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_column).alias("id"),
        whole_text(text_column).alias("text"),
    ).select(
        "row",
        "id",
        F.unhex(F.sha2("text", 256)).alias("content"),
        "text",
        F.posexplode_outer(_pieces(F.col("text"))),
    )
    text = F.when(F.col("pos") == 0, F.col("text")).alias("text")
    return materialise(
        found.select("row", "id", "content", "pos", text, "col.*"), "personal-data-pieces"
    )


def base_spans(pieces: DataFrame) -> DataFrame:
    """row, content, kind, start, end and value of each match."""
    order = Window.partitionBy("row", "kind").orderBy("pos")
    placed = (
        pieces.select("row", "content", "pos", "kind", "gap", "value")
        .filter("kind IS NOT NULL")
        .withColumn("end", F.sum(F.col("gap") + F.coalesce(F.length("value"), F.lit(0))).over(order))
    )
    return (
        placed.filter("value IS NOT NULL")
        .filter(_accepted())
        .select(
            "row",
            "content",
            "kind",
            (F.col("end") - F.length("value")).alias("start"),
            "end",
            F.lower("value").alias("value"),
        )
    )


def _held_terms(text: Column) -> Column:
    """The different terms of a text, outside its addresses."""
    address = PATTERNS[0][1]
    outside = F.when(F.contains(text, F.lit("@")), F.regexp_replace(text, address, "@")).otherwise(text)
    return F.array_distinct(
        F.transform(F.regexp_extract_all(outside, F.lit(TERM), F.lit(0)), lambda word: F.lower(word))
    )


def _steps(text: Column) -> Column:
    """The text as a row of steps: what is skipped (a length), then a term, if one follows."""
    address = F.lit(PATTERNS[0][1])

    def step(skip: Column, word: Column) -> Column:
        return F.struct(F.length(skip).cast("long").alias("skip"), word.alias("word"))

    def parts(gap: Column, value: Column) -> Column:
        words = F.regexp_extract_all(gap, F.lit(TERM), F.lit(0))
        over = step(F.coalesce(value, F.lit("")), F.lit(None).cast("string"))
        return F.concat(F.zip_with(F.split(gap, TERM), words, step), F.array(over))

    gaps = F.split(text, PATTERNS[0][1])
    return F.flatten(F.zip_with(gaps, F.regexp_extract_all(text, address, F.lit(0)), parts))


def term_documents(docs: DataFrame, text_column: str) -> DataFrame:
    """Number of documents that hold each term, over all documents; at least ``SUPPORT``."""
    return (
        docs.select(F.explode(_held_terms(whole_text(text_column))).alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("n_term"))
        .filter(F.col("n_term") >= SUPPORT)
    )


def entity_terms(
    docs: DataFrame, pieces: DataFrame, base: DataFrame, n_docs: int, text_column: str
) -> DataFrame:
    """text (its first row), kind, value, term of entities in their texts, with the counts: stored.

    ``n_texts`` rows have the text. Pairs are left out that cannot reach the threshold: entities
    in fewer than ``SUPPORT`` texts, and terms that are too frequent even if they stand in all
    documents of the entity.
    """
    per_text = (
        base.groupBy("content", "kind", "value")
        .agg(F.count_distinct("row").alias("n_rows"), F.min("row").alias("first_row"))
        .drop("content")
    )
    entities = (
        per_text.groupBy("kind", "value")
        .agg(F.sum("n_rows").alias("n_entity"), F.count(F.lit(1)).alias("n_texts"))
        .filter(F.col("n_texts") >= SUPPORT)
        .drop("n_texts")
    )
    known = per_text.join(entities, ["kind", "value"])
    texts = pieces.filter("text IS NOT NULL").select(F.col("row").alias("first_row"), "text")
    terms = (
        texts.join(known.select("first_row").distinct(), "first_row", "left_semi")
        .select("first_row", F.explode(_held_terms(F.col("text"))).alias("term"))
        .join(term_documents(docs, text_column), "term")
    )
    # n_both <= n_entity: mutual / own >= GENERALISE needs n_term <= N^(1 - g) * n_entity^g
    most = F.pow(F.lit(float(n_docs)), F.lit(1 - GENERALISE)) * F.pow("n_entity", F.lit(GENERALISE))
    return materialise(
        known.join(terms, "first_row").filter(F.col("n_term") <= most * (1 + 1e-9)), "personal-data-terms"
    )


def disclosures(pairs: DataFrame, n_docs: int) -> DataFrame:
    """kind, value, term and the share of the entity's information that the term discloses."""
    together = (
        pairs.groupBy("kind", "value", "term")
        .agg(
            F.sum("n_rows").alias("n_both"),
            F.count(F.lit(1)).alias("support"),
            F.first("n_entity").alias("n_entity"),
            F.first("n_term").alias("n_term"),
        )
        .filter(F.col("support") >= SUPPORT)
    )
    total = F.lit(float(n_docs))
    mutual = F.log2(total * F.col("n_both") / (F.col("n_entity") * F.col("n_term")))
    own = F.log2(total / F.col("n_entity"))
    return together.select("kind", "value", "term", F.when(own > 0, mutual / own).alias("disclosure"))


def term_places(pieces: DataFrame, base: DataFrame, pairs: DataFrame, telling: DataFrame) -> DataFrame:
    """row, start, end and disclosure of every place of a telling term in the entity's documents."""
    per_term = (
        pairs.join(telling, ["kind", "value", "term"])
        .groupBy("first_row", "term")
        .agg(F.max("disclosure").alias("disclosure"))
    )
    per_text = per_term.groupBy("first_row").agg(
        F.map_from_entries(F.collect_list(F.struct("term", "disclosure"))).alias("terms")
    )
    texts = pieces.filter("text IS NOT NULL").select(F.col("row").alias("first_row"), "text")
    stepped = texts.join(per_text, "first_row").select(
        "first_row", "terms", F.posexplode(_steps(F.col("text"))).alias("pos", "step")
    )
    length = F.coalesce(F.length("step.word"), F.lit(0))
    order = Window.partitionBy("first_row").orderBy("pos")
    places = (
        stepped.select(
            "first_row",
            "pos",
            (F.col("step.skip") + length).alias("moved"),
            length.cast("long").alias("length"),
            F.when(length > 0, F.try_element_at("terms", F.lower("step.word"))).alias("disclosure"),
        )
        .withColumn("end", F.sum("moved").over(order))
        .filter("disclosure IS NOT NULL")
        .select("first_row", (F.col("end") - F.col("length")).alias("start"), "end", "disclosure")
    )
    rows = base.select("content", "row").distinct()
    firsts = rows.groupBy("content").agg(F.min("row").alias("first_row"))
    alike = rows.join(firsts, "content").select("row", "first_row")
    return places.join(alike, "first_row").select("row", "start", "end", "disclosure")


def personal_spans(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """row, id, and ``spans`` of each document: kind, start, end (code points), disclosure, action.

    Kinds are numbered as in ``PATTERNS``, terms come last; spans are in the order of kind and
    start. A term that touches a pattern's span is not one of its own. A null or empty text has
    no spans; repeated rows are each searched; an empty table gives no rows; other columns are
    not read.
    """
    pieces = find_pieces(docs, id_column, text_column)
    base = materialise(base_spans(pieces), "personal-data-base")
    n_docs = pieces.filter("pos IS NULL OR pos = 0").count()
    pairs = entity_terms(docs, pieces, base, n_docs, text_column)
    telling = disclosures(pairs, n_docs).filter(F.col("disclosure") >= GENERALISE)
    term_kind = F.lit(len(PATTERNS))
    terms = term_places(pieces, base, pairs, telling).select(
        "row", term_kind.alias("kind"), "start", "end", "disclosure"
    )
    spans = base.select("row", "kind", "start", "end", F.lit(None).cast("double").alias("disclosure"))
    is_base = F.col("kind") < term_kind
    by_place = Window.partitionBy("row").orderBy("start", "kind")
    up_to_here = by_place.rowsBetween(Window.unboundedPreceding, 0)
    from_here = by_place.rowsBetween(0, Window.unboundedFollowing)
    apart = (
        spans.unionByName(terms)
        .withColumn("last_end", F.max(F.when(is_base, F.col("end"))).over(up_to_here))
        .withColumn("next_start", F.min(F.when(is_base, F.col("start"))).over(from_here))
        .filter(
            is_base
            | (
                (F.coalesce("last_end", F.lit(0)) <= F.col("start"))
                & (F.coalesce("next_start", F.col("end")) >= F.col("end"))
            )
        )
    )
    action = (
        F.when(is_base, "mask").when(F.col("disclosure") >= REMOVE, "remove").otherwise("generalise")
    )
    span = F.struct("kind", "start", "end", "disclosure", action.alias("action"))
    everyone = pieces.filter("pos IS NULL OR pos = 0").select("row", "id", F.lit(None).alias("span"))
    return (
        apart.select("row", F.lit(None).cast(everyone.schema["id"].dataType).alias("id"), span.alias("span"))
        .unionByName(everyone)
        .groupBy("row")
        .agg(F.max("id").alias("id"), F.sort_array(F.collect_list("span")).alias("spans"))
    )


def sanitised(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id and text with every span masked, generalised (to its initial) or removed.

    The ids must be unique: spans come back to the texts by id.
    """
    names = F.array(*(F.lit(f"[{name.upper()}]") for name, _ in PATTERNS))
    spans = personal_spans(docs, id_column, text_column).select(F.col("id").alias(id_column), "spans")
    by_place = F.array_sort(
        "spans", lambda a, b: F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).otherwise(0)
    )
    text = whole_text(text_column)

    def rewritten(ordered: Column) -> Column:
        def piece(span: Column, i: Column) -> Column:
            begin = F.when(i == 0, F.lit(0).cast("long")).otherwise(F.get(ordered, i - 1)["end"])
            kept = F.substr(text, (begin + 1).cast("int"), F.greatest(span["start"] - begin, F.lit(0)).cast("int"))
            first = F.substr(text, (span["start"] + 1).cast("int"), F.lit(1))
            instead = (
                F.when(span["action"] == "mask", F.get(names, span["kind"]))
                .when(span["action"] == "generalise", F.concat(first, F.lit(".")))
                .otherwise("")
            )
            return F.concat(kept, instead)

        last = F.when(F.size(ordered) > 0, F.element_at(ordered, -1)["end"]).otherwise(0)
        rest = F.substr(text, (last + 1).cast("int"), F.length(text))
        return F.concat(F.array_join(F.transform(ordered, piece), ""), rest)

    return docs.join(spans, id_column).select(id_column, once(by_place, rewritten).alias(text_column))
