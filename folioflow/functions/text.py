"""Text functions as Catalyst expressions: tokens, chunks, sections and the paper's context map.

White space is the class SPACE everywhere, and word characters are spelled out as classes, so that the expressions
mean the same here and in other engines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\s\p{Z}\x1c-\x1f\x85]"
#: The same characters one by one, for trimming: a pattern's cost grows with the square of a run of them.
SPACES = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
# Words that never align, and the headings that begin sections.
STOP_WORDS = ["the", "and", "for", "with", "from", "that", "this", "were", "was", "are", "fig", "figure", "table", "panel", "data", "shown", "using", "into", "than"]
ABSTRACT_ENDS = r"introduction|background|methods?|materials?\s+and\s+methods?|results?|discussion|keywords?|1[.\s]|2[.\s]"
SECTION_ENDS = r"abstract|introduction|background|methods?|materials?\s+and\s+methods?|results?|discussion|conclusions?|references|acknowledg"
SECTIONS = (
    ("Research problem / introduction", r"introduction|background", 180),
    ("Methods / experimental system", r"methods?|materials?\s+and\s+methods?", 180),
    ("Main results", r"results?", 260),
    ("Discussion / conclusion", r"discussion|conclusions?", 220),
)
CHUNK_WORDS, OVERLAP, LEAST_TAIL, MAP_WORDS, ABSTRACT_CHARS, ABSTRACT_WORDS = 250, 40, 20, 1100, 3000, 400


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def bound(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once however often the body has it: in functions of arrays nothing else shares it."""
    return F.transform(F.array(value), body)[0]


def tokens(text: str | Column) -> Column:
    """Lower-case words: runs of letters, digits and underscores."""
    return F.regexp_extract_all(F.lower(F.coalesce(_c(text), F.lit(""))), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))


def alignment_terms(text: str | Column) -> Column:
    """Distinct terms that align OCR with a text, as they are written; stop words are left out."""
    found = F.regexp_extract_all(F.coalesce(_c(text), F.lit("")), F.lit(r"[A-Za-z0-9][A-Za-z0-9_.+-]+"), F.lit(0))
    stop = F.array(*[F.lit(w) for w in STOP_WORDS])
    return F.array_distinct(F.filter(found, lambda t: ~F.array_contains(stop, F.lower(t))))


def stripped(text: str | Column) -> Column:
    """``text`` without white space around it."""
    return F.btrim(_c(text), F.lit(SPACES))


def words(text: str | Column) -> Column:
    """Words between white space."""
    return F.filter(F.split(F.coalesce(_c(text), F.lit("")), f"{SPACE}+"), lambda w: w != "")


def first_words(text: str | Column, n: int) -> Column:
    """The first ``n`` words in single spaces; the text behind them isn't cut up."""
    cut = F.split(F.coalesce(_c(text), F.lit("")), f"{SPACE}+", n + 2)  # one for an empty string before the first word, one for the rest
    return F.array_join(F.slice(F.filter(cut, lambda w: w != ""), 1, n), " ")


def collapsed(text: str | Column) -> Column:
    return F.array_join(words(text), " ")


def paragraphs(text: str | Column, separator: str = r"\n{2,}") -> Column:
    """Non-empty paragraphs, white space around them removed."""
    parts = F.transform(F.split(F.coalesce(_c(text), F.lit("")), separator), lambda p: stripped(p))
    return F.filter(parts, lambda p: p != "")


def sliding(word_list: Column, size: int = CHUNK_WORDS, overlap: int = OVERLAP) -> Column:
    """Overlapping segments of ``size`` words; a segment of fewer than LEAST_TAIL words is dropped."""
    check_chunking(size, overlap)
    starts = lambda w: F.sequence(F.lit(0), F.greatest(F.size(w) - F.lit(1), F.lit(0)), F.lit(size - overlap))
    parts = bound(word_list, lambda w: F.transform(starts(w), lambda s: F.slice(w, s + F.lit(1), F.lit(size))))
    return F.filter(parts, lambda p: F.size(p) >= LEAST_TAIL)


def check_chunking(size: int, overlap: int) -> None:
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and less than the chunk")


def chunks(text: str | Column, size: int = CHUNK_WORDS, overlap: int = OVERLAP, separator: str = r"\n{2,}") -> Column:
    """Chunks of a text, in order, as arrays of words.

    Paragraphs are packed until one more would exceed ``size``; then the last ``overlap`` words are carried over. A
    paragraph of more than one and a half times ``size`` becomes sliding segments, and what is pending stays pending.
    """
    check_chunking(size, overlap)
    none = F.array().cast("array<string>")
    start = F.struct(F.array().cast("array<array<string>>").alias("out"), none.alias("cur"))

    def step(acc, p):
        out, cur = acc["out"], acc["cur"]
        tail = F.slice(cur, F.greatest(F.size(cur) - F.lit(overlap - 1), F.lit(1)), F.lit(overlap)) if overlap else none
        return (
            F.when(F.size(p) * 2 > 3 * size, F.struct(F.concat(out, sliding(p, size, overlap)).alias("out"), cur.alias("cur")))
            .when((F.size(cur) > 0) & (F.size(cur) + F.size(p) > size), F.struct(F.concat(out, F.array(cur)).alias("out"), F.concat(tail, p).alias("cur")))
            .otherwise(F.struct(out.alias("out"), F.concat(cur, p).alias("cur")))
        )

    parts = F.transform(paragraphs(text, separator), lambda p: words(p))
    done = lambda acc: F.when(F.size(acc["cur"]) > 0, F.concat(acc["out"], F.array(acc["cur"]))).otherwise(acc["out"])
    return F.aggregate(parts, start, step, done)


def chunk_rows(papers: DataFrame, paper: str, text: str, **how) -> DataFrame:
    """(paper, chunk_ix, text, n_words), a row per chunk."""
    rows = papers.select(paper, F.posexplode(chunks(text, **how)).alias("chunk_ix", "_w"))
    return rows.select(paper, "chunk_ix", F.array_join("_w", " ").alias("text"), F.size("_w").alias("n_words"))


#: Before each line that begins with a heading of any kind; only a line feed ends a line.
_HEADING_LINE = rf"(?idm)^(?=[^\S\n]*(?:{ABSTRACT_ENDS}|{SECTION_ENDS}))"


def heading_parts(text: str | Column) -> Column:
    """The text cut before its heading lines, in one scan: all sections are made of these parts."""
    return F.split(F.coalesce(_c(text), F.lit("")), _HEADING_LINE)


def _below(parts_: Column, begins: str, ends: str) -> Column:
    """struct(body, ended) of the first part that ``begins``, without its heading, up to the first later part that ``ends``; null if none does.

    Both patterns look at a part's beginning only, so what is long is copied once, and only where it is wanted.
    """
    none = F.lit(None).cast("struct<body:string,ended:boolean>")

    def cut(p: Column, first: Column, stop: Column) -> Column:
        body = F.array_join(F.slice(p, first, F.when(stop > 0, stop).otherwise(F.size(p))), "")
        return F.struct(F.regexp_replace(body, begins, "").alias("body"), (stop > 0).alias("ended"))

    def later(p: Column, first: Column) -> Column:
        rest = F.slice(p, first + F.lit(1), F.size(p))
        return bound(F.array_position(F.transform(rest, lambda x: x.rlike(ends)), True).cast("int"), lambda stop: cut(p, first, stop))

    begin = lambda p: F.array_position(F.transform(p, lambda x: x.rlike(begins)), True).cast("int")
    return bound(parts_, lambda p: bound(begin(p), lambda first: F.when(first > 0, later(p, first)).otherwise(none)))


def abstract_of(parts_: Column, text: Column) -> Column:
    found = _below(parts_, r"(?i)\A\s*abstract\s*\n", rf"(?i)\A[^\S\n]*(?:{ABSTRACT_ENDS})")
    cut = bound(found, lambda f: stripped(F.when(f["ended"], f["body"]).otherwise(F.substring(f["body"], F.lit(1), F.lit(ABSTRACT_CHARS)))))
    return bound(cut, lambda c: F.when(c != "", c).otherwise(first_words(text, ABSTRACT_WORDS)))


def section_of(parts_: Column, headings: str, most: int) -> Column:
    found = _below(parts_, rf"(?i)\A\s*(?:{headings})\b[^\n]*\n", rf"(?i)\A[^\S\n]*(?:{SECTION_ENDS})\b")
    return first_words(F.coalesce(found["body"], F.lit("")), most)


def abstract(text: str | Column) -> Column:
    """The abstract: from its heading to the next one, or ABSTRACT_CHARS; without one, the first words."""
    return abstract_of(heading_parts(text), F.coalesce(_c(text), F.lit("")))


def section(text: str | Column, headings: str, most: int) -> Column:
    """The first ``most`` words below a line that begins with one of the headings, up to the next known heading."""
    return section_of(heading_parts(text), headings, most)


def with_context_map(df: DataFrame, text: str, name: str = "paper_map", most: int = MAP_WORDS) -> DataFrame:
    """``df`` with the paper's named parts, or its first words if it has none; at most ``most`` words (500 at least).

    Each step is a column of its own, so that no part is computed twice.
    """
    budget = max(most, 500)
    out = df.withColumn("_t", F.coalesce(_c(text), F.lit(""))).withColumn("_parts", heading_parts("_t")).withColumn("_p0", abstract_of(F.col("_parts"), F.col("_t")))
    out = out.withColumns({f"_p{k}": section_of(F.col("_parts"), h, m) for k, (_, h, m) in enumerate(SECTIONS, 1)})
    names = ["Abstract", *[n for n, _, _ in SECTIONS]]
    out = out.withColumns({f"_p{k}": collapsed(f"_p{k}") for k in range(len(names))})
    parts = [F.when(F.col(f"_p{k}") != "", F.concat(F.lit(f"{n}: "), F.col(f"_p{k}"))) for k, n in enumerate(names)]
    out = out.withColumn("_all", F.concat_ws("\n", *parts))
    out = out.withColumn("_all", F.when(F.col("_all") != "", F.col("_all")).otherwise(first_words("_t", budget))).withColumn("_w", words("_all"))
    cut = F.when(F.size("_w") > budget, F.concat(F.array_join(F.slice("_w", 1, budget), " "), F.lit(" [paper map truncated]"))).otherwise(F.col("_all"))
    out = out.withColumn(name, F.when(F.col("_t") == "", F.lit("")).otherwise(cut))
    return out.drop("_t", "_parts", "_all", "_w", *[f"_p{k}" for k in range(len(names))])


def abstract_block(text: str | Column) -> Column:
    """The abstract below its title, for a prompt; empty for a blank text."""
    return F.when(stripped(F.coalesce(_c(text), F.lit(""))) != "", F.concat(F.lit("PAPER ABSTRACT:\n"), abstract(text), F.lit("\n\n"))).otherwise("")


def full_context(text: str | Column, most: int = 0) -> Column:
    """struct(text, note): the whole text in single spaces, or its first ``most`` words (0: all), and what was done."""
    w = words(text)
    n = F.size(w)
    if most > 0:
        note = F.when(n > most, F.concat(F.lit(f" [truncated at {most} words, original: "), n.cast("string"), F.lit("]")))
        note = note.otherwise(F.concat(F.lit(" ["), n.cast("string"), F.lit(" words]")))
        return F.struct(F.array_join(F.slice(w, 1, most), " ").alias("text"), note.alias("note"))
    return F.struct(F.array_join(w, " ").alias("text"), F.concat(F.lit(" ["), n.cast("string"), F.lit(" words]")).alias("note"))


def joined_pages(pages: DataFrame) -> DataFrame:
    """(paper_id, text): non-empty pages in order, each below its number."""
    shown = pages.filter(stripped("text") != "").select("paper_id", F.struct("page", F.concat(F.lit("[Page "), F.col("page").cast("string"), F.lit("]\n"), stripped("text")).alias("t")).alias("_p"))
    return shown.groupBy("paper_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("_p")), lambda p: p["t"]), "\n\n").alias("text"))
