"""Splitting, cleaning and gating text. Every plan here is narrow."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paralex import fixed_values as V
from paralex.functions.core import alternation, any_of, col, let, strip, with_kept

def _empty() -> Column:
    return F.array().cast("array<string>")


def _pack(pieces: Column, limit: int, spacer: str = "") -> Column:
    """Greedy packing of ``STRUCT<quoted, piece>`` into chunks of ``limit``.

    A piece that arrives ``quoted`` closes the quotation of the last finished
    chunk.  Chunks come out trimmed; a piece over the limit stays whole.
    """

    def add(acc: Column, p: Column) -> Column:
        closed = F.when(
            p["quoted"] & (F.size(acc["done"]) > 0),
            F.concat(
                F.slice(acc["done"], F.lit(1), F.size(acc["done"]) - 1),
                F.array(F.concat(F.element_at(acc["done"], -1), F.lit(V.CLOSING_QUOTE))),
            ),
        ).otherwise(acc["done"])
        piece = F.concat(p["piece"], F.lit(spacer)) if spacer else p["piece"]
        fits = (piece == "") | (F.length(acc["open"]) + F.length(piece) <= limit)
        return F.struct(
            F.when(fits, closed)
            .otherwise(F.concat(closed, F.array(strip(acc["open"]))))
            .alias("done"),
            F.when(fits, F.concat(acc["open"], piece)).otherwise(piece).alias("open"),
        )

    return F.aggregate(
        pieces,
        F.struct(_empty().alias("done"), F.lit("").alias("open")),
        add,
        lambda acc: F.when(
            acc["open"] != "", F.concat(acc["done"], F.array(strip(acc["open"])))
        ).otherwise(acc["done"]),
    )


def _clauses(text: Column, limit: int, mark: str, tail: str) -> Column:
    """Cut at ``mark`` and pack; ``mark`` returns where no sign of ``tail`` ends
    the piece."""

    def prepare(s: Column) -> Column:
        quoted = F.startswith(s, F.lit(V.CLOSING_QUOTE))
        bare = F.when(quoted, F.substr(s, F.lit(2))).otherwise(s)
        ended = F.instr(F.lit(tail), F.right(bare, F.lit(1))) > 0
        return F.struct(
            quoted.alias("quoted"),
            F.when((bare == "") | ended, bare).otherwise(F.concat(bare, F.lit(mark))).alias("piece"),
        )

    pieces = F.filter(F.split(text, alternation([mark])), lambda s: s != "")
    return _pack(F.transform(pieces, prepare), limit)


def split_clauses(
    df: DataFrame,
    text: str = "text",
    limit: int = V.CLAUSE_LIMIT,
    sentence_mark: str = V.CLAUSE_SENTENCE_MARK,
    phrase_mark: str = V.CLAUSE_PHRASE_MARK,
    tail: str = V.CLAUSE_TAIL,
) -> DataFrame:
    """One row per clause of at most ``limit`` characters: ``para, pos, clause``.

    Paragraphs of up to two characters go.  Longer ones than ``limit`` are
    packed from sentences, sentences still longer from phrases; a single phrase
    over the limit stays whole.  Blank clauses are dropped.
    """
    paragraphs = df.select("*", F.posexplode(F.split(col(text), "\n")).alias("para", "_p")).filter(
        F.length("_p") > 2
    )

    def phrases(s: Column) -> Column:
        return F.when(F.length(s) <= limit, F.array(s)).otherwise(_clauses(s, limit, phrase_mark, tail))

    cut = F.when(
        F.length("_p") > limit,
        F.flatten(F.transform(_clauses(F.col("_p"), limit, sentence_mark, tail), phrases)),
    ).otherwise(F.array(strip("_p")))
    kept = F.filter(cut, lambda s: s != "")
    return paragraphs.select(
        *df.columns, "para", F.posexplode(kept).alias("pos", "clause")
    )


def pack_sentences(
    df: DataFrame, text: str = "text", limit: int = V.PACK_LIMIT, keep_empty: bool = False
) -> DataFrame:
    """One row per chunk of whole sentences: ``para, pos, chunk``.

    Sentences of a paragraph end at ``.!?`` followed by spaces and are packed
    up to ``limit`` characters, counting one space after each.  Empty chunks
    (blank paragraph, over-long first sentence) go unless ``keep_empty``.
    """
    paragraphs = df.select("*", F.posexplode(F.split(strip(text), "\n")).alias("para", "_p"))
    pieces = F.transform(
        F.split(strip("_p"), V.SENTENCE_BREAK),
        lambda s: F.struct(F.lit(False).alias("quoted"), strip(s).alias("piece")),
    )
    chunks = _pack(pieces, limit, " ")
    chunks = chunks if keep_empty else F.filter(chunks, lambda s: s != "")
    return paragraphs.select(*df.columns, "para", F.posexplode(chunks).alias("pos", "chunk"))


def clean_sentence(text: str | Column, lang: str | Column) -> Column:
    """Ordered clean-up of a translated sentence by its language.

    Every step is bound by :func:`let`, as its test and both its branches name
    the text before it.
    """
    text, lang = col(text), col(lang)
    drop = lambda c, pattern: F.regexp_replace(c, pattern, "")
    # Cheap tests keep the searches off texts that cannot match.
    where = lambda test, pattern: lambda t: F.when(test(t), drop(t, pattern)).otherwise(t)
    steps = [
        where(lambda t: F.contains(t, F.lit("(")), V.CLEAN_BRACKETED),
        where(lambda t: F.contains(t, F.lit("https:")), V.CLEAN_URL.replace("{s}", V.SPACE)),
        lambda t: F.when(lang == "zh-cn", drop(drop(t, V.CLEAN_ZH_BRACKETED), V.CLEAN_ZH_LABEL))
        .when(lang == "ja", drop(t, V.CLEAN_JA_LABEL))
        .when(t.rlike(f"[{V.HAN}]"), drop(t, V.CLEAN_HAN_RUN.replace("{s}", V.SPACE)))
        .otherwise(t),
        # The remark pattern backtracks; only texts with the word are worth it.
        where(lambda t: F.contains(F.lower(t), F.lit("translat")) & (lang != "en"), V.CLEAN_TRANSLATION_REMARK),
        lambda t: strip(drop(t, any_of(V.SENTENCE_LABELS))),
        lambda t: strip(drop(drop(t, V.CLEAN_LEADING), V.CLEAN_TRAILING_NAME)),
    ]
    cleaned = reduce(let, steps, text)
    return F.when((text == "") | text.rlike(V.CLEAN_ECHO), "").otherwise(cleaned)


def clean_translation(
    df: DataFrame,
    text: str = "text",
    lang: str = "lang",
    langs: Sequence[str] = tuple(V.CLEANED_LANGS),
) -> DataFrame:
    """Clean the texts whose language is in ``langs``; others pass untouched."""
    cleaned = F.when(F.col(lang).isin(list(langs)), clean_sentence(text, lang)).otherwise(F.col(text))
    return df.withColumn(text, F.coalesce(cleaned, F.lit("")))


def strip_label(text: str | Column, labels: Sequence[str] = tuple(V.LINE_LABELS)) -> Column:
    """Remove one leading label, the longest that fits, then trim."""
    return strip(F.regexp_replace(col(text), f"^(?:{alternation(labels)})", ""))


def strip_label_prefix(
    df: DataFrame, text: str = "line", labels: Sequence[str] = tuple(V.LINE_LABELS)
) -> DataFrame:
    return df.withColumn(text, strip_label(text, labels))


def normalize(text: str | Column, mode: str = "match") -> Column:
    """``match`` drops a fixed set of marks and white space; ``search`` lowers
    and drops all Unicode punctuation and white space."""
    if mode == "match":  # a regex tries every range and wide mark of its class on every character
        return F.translate(col(text), V.MATCH_PUNCTUATION_CHARS + V.SPACE_CHARS, "")
    return F.lower(F.regexp_replace(col(text), f"[{V.SEARCH_PUNCTUATION}{V.SPACE}]+", ""))


def normalize_for_match(df: DataFrame, mode: str, text: str = "text") -> DataFrame:
    return df.withColumn("normalized", normalize(text, mode))


def is_all_upper(text: str | Column) -> Column:
    """At least one letter with case, and no lower-case letter."""
    c = col(text)
    return (F.upper(c) == c) & (F.lower(c) != c)


def _shared(a: Column, b: Column, side: Callable[[Column, Column], Column]) -> Column:
    """Length of the common prefix (``side=F.left``) or suffix, by bisection."""
    most = F.least(F.length(a), F.length(b))
    bits = F.array(*[F.lit(1 << i) for i in range(30, -1, -1)])

    def step(n: Column, bit: Column) -> Column:
        longer = n + bit
        return F.when((longer <= most) & (side(a, longer) == side(b, longer)), longer).otherwise(n)

    return F.aggregate(F.filter(bits, lambda x: x <= most), F.lit(0), step)


def _within(a: Column, b: Column, limit: int) -> Column:
    """Whether two texts are at most ``limit`` edits apart.

    Equal texts and lengths too far apart need no distance.  Dropping a common
    prefix and suffix leaves the distance as it is; for long texts it turns a
    quadratic comparison into one of the few characters that differ.  A distance
    beyond the limit is -1.
    """

    def middles(p: Column) -> Column:
        def tails(n: Column) -> Column:
            rest = F.struct(F.substr(p["a"], n + 1).alias("a"), F.substr(p["b"], n + 1).alias("b"))
            return let(rest, heads)

        def heads(r: Column) -> Column:
            return let(
                _shared(r["a"], r["b"], F.right),
                lambda n: F.levenshtein(
                    F.left(r["a"], F.length(r["a"]) - n), F.left(r["b"], F.length(r["b"]) - n), limit
                ),
            )

        return let(_shared(p["a"], p["b"], F.left), tails)

    short = F.least(F.length(a), F.length(b)) < 128
    return (
        F.when(a == b, True)
        .when(F.abs(F.length(a) - F.length(b)) > limit, False)
        .when(short, F.levenshtein(a, b, limit) >= 0)
        .otherwise(middles(F.struct(a.alias("a"), b.alias("b"))) >= 0)
    )


def edit_distance_gate(
    df: DataFrame,
    lang: str,
    max_edits: int = V.MAX_EDITS,
    source: str = "src",
    target: str = "text",
) -> DataFrame:
    """Keep rows whose normalised source and target differ by few edits.

    English compares in lower case and rejects an all-upper-case target.  A
    missing side rejects.  Both sides are bound once per row: as a plain filter
    the gate would be pushed below whatever computes them, which would then run
    again for every place that names a side.  Normalising drops characters one
    by one and a common prefix adds no edits, so only what follows it is
    normalised.
    """

    def rests(p: Column) -> Column:
        shared = F.when(F.startswith(p["b"], p["a"]), F.length(p["a"])).otherwise(_shared(p["a"], p["b"], F.left))
        return let(shared, lambda n: F.struct(*[normalize(F.substr(p[side], n + 1)).alias(side) for side in ("a", "b")]))

    def passes(p: Column) -> Column:
        sides = p
        if lang == "en":
            sides = F.struct(F.lower(p["a"]).alias("a"), F.lower(p["b"]).alias("b"))
        close = let(let(sides, rests), lambda n: _within(n["a"], n["b"], max_edits))
        if lang == "en":
            close = ~is_all_upper(p["b"]) & close
        return F.coalesce(close, F.lit(False))

    pair = F.struct(F.col(source).alias("a"), F.col(target).alias("b"))
    return with_kept(df, "_pair", pair, passes).drop("_pair")


def char_counts(text: str | Column, vocabulary: Column, char_class: str = V.HAN) -> Column:
    """``STRUCT<n_class, n_missing, missing_ratio>`` of a text.

    ``vocabulary`` is one string of known characters.  Counting what
    ``translate`` leaves over is linear in the text, with no shuffle and no
    row per character.  Without a character of the class the ratio is null.
    """
    within = F.regexp_replace(col(text), f"[^{char_class}]+", "")
    sizes = F.struct(
        F.length(within).alias("n"),
        F.length(F.call_function("translate", within, vocabulary, F.lit(""))).alias("out"),
    )
    return F.struct(
        sizes["n"].alias("n_class"),
        sizes["out"].alias("n_missing"),
        F.when(sizes["n"] > 0, sizes["out"].cast("double") / sizes["n"]).alias("missing_ratio"),
    )


def char_ratio(
    df: DataFrame, vocabulary: Column, char_class: str = V.HAN, text: str = "text"
) -> DataFrame:
    """Add ``n_class``, ``n_missing`` and ``missing_ratio`` per row."""
    counted = df.withColumn("_r", char_counts(text, vocabulary, char_class))
    return counted.select(*df.columns, "_r.*")


def source_after_last(
    prompt: str | Column, name: str = "English", stop: str = "Chinese"
) -> Column:
    """Text after the last ``name: `` and before the first ``stop: ``."""
    tail = F.substring_index(col(prompt), f"{name}: ", -1)
    return strip(F.substring_index(tail, f"{stop}: ", 1))


def source_after_second(prompt: str | Column, name: str = "English") -> Column:
    """First line after the second ``name: `` (after the first if there is one only)."""
    tail = F.element_at(F.split(col(prompt), alternation([f"{name}: "]), 3), -1)
    return strip(F.substring_index(tail, "\n", 1))


def lang_dimension(spark) -> DataFrame:
    """The language table: 44 fixed rows."""
    return spark.createDataFrame(V.LANGUAGES, "code string, english string, chinese string, nllb string")


def lang_lookup(df: DataFrame, lang: str = "lang") -> DataFrame:
    """Add the names of each row's language; the dimension has 44 fixed rows,
    so it is broadcast."""
    dim = lang_dimension(df.sparkSession).withColumnRenamed("code", lang)
    return df.join(F.broadcast(dim), lang, "left")
