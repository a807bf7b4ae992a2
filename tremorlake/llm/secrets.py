"""Secret scans: known shapes, and windows of high entropy.

Everything is an expression of DataFrame functions. Java's regular expressions
give matches but no places, so places come from lengths: the text between the
matches (`split`) and the matches alternate, and a running sum over both is where
each match ends. Only documents that have a candidate at all are cut up.

The entropy scan slides a window over each candidate string and keeps the counts
of its characters, taking one in and one out at each step. With c the counts and
w the window, the entropy is log2(w) - sum(c * log2(c)) / w; the sum changes by
two terms a step. Thresholds depend on the class of characters in the candidate; a
window of hex digits alone has the threshold of hex in any candidate, and its span is
the whole run of hex digits. Known harmless forms are suppressed: a candidate that is
one as a whole, and windows that overlap a placeholder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tremorlake.llm.common import free_names, text_key

# Pattern, least length, and the group that length is of, by kind.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex", "entropy")

CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
_CODES = 128  # a candidate is ASCII

# Least entropy in bits of a window of 20 characters, by class of the candidate.
# Random text of the classes has about 3.4, 4.0 and 4.1 bits; words have less. Of random
# strings of 20 characters each threshold misses under a tenth, see README.
CLASSES = (
    ("hex", r"^[0-9a-fA-F]+$", 3.1),
    ("letters", r"^[A-Za-z]+$", 3.7),
    ("mixed", r"", 3.7),
)

# Candidates that are no secrets: identifiers of a public form, words joined by
# signs, paths, and runs of digits.
ALLOWED = (
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"^[A-Za-z]{1,15}([-_/=+]+[A-Za-z]{1,15})*[-_/=+]*$",
    r"^[0-9+/_=-]+$",
)
# Characters of placeholders: a window with one of them has no entropy span, the rest of
# the candidate is scanned. Each character in turn, so that the places stay.
PLACEHOLDERS = ("example", "placeholder", "your_", "your-", "changeme", "xxxx", "0123456789", "abcdefgh")
HARMLESS = "(?i)" + "|".join(
    f"(?<={word[:at]}){word[at]}(?={word[at + 1:]})" for word in PLACEHOLDERS for at in range(len(word))
)
_MASK = "!"  # in no candidate


def _pieces(kind: str, pattern: str, guard: str, least: int, group: int = 0) -> Column:
    """An array of (kind, gap, len, ok, value), a struct per match and one for the rest."""
    text, pieces = F.col("text"), "array<struct<kind:int,gap:int,len:int,ok:boolean,value:string>>"
    wholes = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))

    def piece(match: Column) -> Column:
        gap, whole, value = match["0"], match["1"], match["2"]
        return F.struct(
            F.lit(KINDS.index(kind)).alias("kind"),
            F.length(gap).alias("gap"),
            F.coalesce(F.length(whole), F.lit(0)).alias("len"),
            F.coalesce(F.length(value) >= least, F.lit(False)).alias("ok"),
            value.alias("value"),
        )

    zipped = F.transform(F.arrays_zip(F.split(text, pattern, -1), wholes, values), piece)
    return F.when(text.rlike(guard), zipped.cast(pieces)).otherwise(F.array().cast(pieces))


def _matches(texts: DataFrame) -> DataFrame:
    """id, text_hash, kind, start, end and hot of every match in distinct texts; hot are
    the spans of high entropy in a candidate, found where the text is read.

    Matches that are too short take their text with them for assignments. For the
    others a longer match can't begin inside a short one, so the least length can
    be in the pattern.
    """
    shapes = [
        _pieces("assign", ASSIGN, ASSIGN.removesuffix("+)") + f"{{{LEAST['assign']},}})", LEAST["assign"], 2),
        *(
            _pieces(kind, pattern, pattern, LEAST[kind])
            for kind, pattern in (
                ("access", ACCESS.removesuffix("+") + f"{{{LEAST['access'] - 4},}}"),
                ("hex", HEX.removesuffix("+") + f"{{{LEAST['hex']},}}"),
            )
        ),
        _pieces("entropy", CANDIDATE, CANDIDATE, WINDOW),
    ]
    pieces = texts.select("id", "text_hash", F.posexplode(F.concat(*shapes)).alias("at", "m")).select(
        "id", "text_hash", "at", "m.*"
    )
    hot = F.when(F.col("ok") & (F.col("kind") == KINDS.index("entropy")), entropy_spans("value"))
    pieces = pieces.withColumn("hot", hot).drop("value")
    # The same text twice is one text; sums and spans below need no further exchange.
    one = pieces.repartition("id", "text_hash").dropDuplicates(["id", "text_hash", "at"])
    through = Window.partitionBy("id", "text_hash", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    return (
        one.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(through))
        .where("ok")
        .select("id", "text_hash", "kind", (F.col("end") - F.col("len")).alias("start"), "end", "hot")
    )


def entropy_spans(value: str, window: int = WINDOW) -> Column:
    """Merged spans (start, end) of the windows of a string column that are over the
    threshold of its class, and of the runs of hex digits with a window over that of
    hex that is not of digits alone; none if the string is allowed or null."""
    log = [F.lit(0.0)] + [F.lit(n).cast("double") * F.log2(F.lit(n)) for n in range(1, window + 1)]
    text = F.col(value)
    threshold = F.lit(None).cast("double")
    for _, pattern, bits in reversed(CLASSES):
        threshold = F.when(text.rlike(pattern), F.lit(bits)).otherwise(threshold)
    # A window is over the threshold if its sum of c * log2(c) is under this. It is in
    # the state, so that the patterns are tried once and not at each step.
    most = (F.log2(F.lit(window)) - threshold) * window
    most_hex = (F.log2(F.lit(window)) - dict((name, bits) for name, _, bits in CLASSES)["hex"]) * window

    terms = F.array(*log)

    def term(n: Column) -> Column:
        return F.element_at(terms, n + 1)

    def move(code: Column, by: int) -> Column:
        digit = code.between(ord("0"), ord("9"))
        is_hex = digit | code.between(ord("A"), ord("F")) | code.between(ord("a"), ord("f"))
        return F.struct((code + 1).alias("place"), F.lit(by).alias("by"), digit.alias("digit"), is_hex.alias("hex"))

    # The string is cut into characters once. Each comes in after the one that leaves the window.
    masked = F.when(text.rlike("(?i)" + "|".join(PLACEHOLDERS)), F.regexp_replace(text, HARMLESS, _MASK)).otherwise(text)
    codes = F.transform(F.split(masked, ""), F.ascii)
    old = F.slice(codes, F.lit(1), F.greatest(F.length(text) - window, F.lit(0)))
    moves = F.flatten(
        F.zip_with(
            codes,
            F.concat(F.array_repeat(F.lit(-1), window), old),
            lambda come, gone: F.when(gone < 0, F.array(move(come, 1))).otherwise(F.array(move(gone, -1), move(come, 1))),
        )
    )

    def step(state: Column, move: Column) -> Column:
        place, by, counts, spans = move["place"], move["by"], state["counts"], state["spans"]
        count = F.element_at(counts, place)
        changed = F.concat(
            F.slice(counts, F.lit(1), place - 1), F.array(count + by), F.slice(counts, place + 1, F.lit(_CODES) - place)
        )
        total = state["total"] + term(count + by) - term(count)
        end = state["end"] + F.greatest(by, F.lit(0))
        start, last = end - window, F.element_at(spans, -1)
        comes = by > 0
        # Where the runs of hex digits and of digits begin that reach to here.
        run = F.when(comes & ~move["hex"], end).otherwise(state["run"])
        digits = F.when(comes & ~move["digit"], end).otherwise(state["digits"])
        harmless = F.element_at(changed, ord(_MASK) + 1) > 0
        hot = comes & (start >= 0) & (total < state["most"]) & ~harmless
        hot_hex = comes & (run <= start) & (digits > start) & (total < most_hex)
        in_hex = F.when(comes, hot_hex | (state["in_hex"] & move["hex"])).otherwise(state["in_hex"])
        to_run = comes & in_hex
        first = F.when(to_run, F.when(hot, F.least(start, run)).otherwise(run)).otherwise(start)
        joined = F.concat(
            F.filter(spans, lambda span: span["end"] < first),
            F.array(
                F.struct(
                    F.least(first, F.filter(spans, lambda span: span["end"] >= first)[0]["start"]).alias("start"),
                    end.alias("end"),
                )
            ),
        )
        added = F.concat(spans, F.array(F.struct(first.alias("start"), end.alias("end"))))
        grown = (
            F.when(~(hot | to_run), spans).when((F.size(spans) > 0) & (first <= last["end"]), joined).otherwise(added)
        )
        return F.struct(
            end.alias("end"),
            changed.alias("counts"),
            total.alias("total"),
            state["most"].alias("most"),
            run.alias("run"),
            digits.alias("digits"),
            in_hex.alias("in_hex"),
            grown.alias("spans"),
        )

    none = F.array().cast("array<struct<start:int,end:int>>")
    begin = F.struct(
        F.lit(0).alias("end"),
        F.array_repeat(F.lit(0), _CODES).alias("counts"),
        F.lit(0.0).alias("total"),
        most.alias("most"),
        F.lit(0).alias("run"),
        F.lit(0).alias("digits"),
        F.lit(False).alias("in_hex"),
        none.alias("spans"),
    )
    scanned = F.aggregate(moves, begin, step, lambda state: state["spans"])
    allowed = F.lit(False)
    for pattern in ALLOWED:
        allowed = allowed | text.rlike(pattern)
    return F.when(text.isNull() | allowed | (F.length(text) < window), none).otherwise(scanned)


def find_secrets(docs: DataFrame) -> DataFrame:
    """id, text_hash and `found` of each text that has secrets: an array of (start,
    kind, end), ordered, in code points, end exclusive; kind is a place in KINDS.

    An entropy span inside a span of a known shape is left out.
    """
    texts = docs.where("text IS NOT NULL").select(F.col("doc_id").alias("id"), text_key().alias("text_hash"), "text")
    matches = _matches(texts)
    whole = F.array(F.struct(F.lit(0).alias("start"), (F.col("end") - F.col("start")).cast("int").alias("end")))
    # One branch for all kinds: the matches are made in one pass over the texts.
    spans = matches.select(
        "id", "text_hash", "kind", F.col("start").alias("at"), F.explode(F.coalesce("hot", whole)).alias("span")
    ).select(
        "id", "text_hash", "kind", (F.col("at") + F.col("span.start")).alias("start"), (F.col("at") + F.col("span.end")).alias("end")
    )
    known = F.col("kind") < KINDS.index("entropy")
    # The texts of the matches are together already, so this needs no exchange either.
    so_far = Window.partitionBy("id", "text_hash").orderBy("start", "kind", "end").rowsBetween(Window.unboundedPreceding, 0)
    reach = F.coalesce(F.max(F.when(known, F.col("end"))).over(so_far), F.lit(0))
    return (
        spans.withColumn("reach", reach)
        .where(known | (F.col("reach") < F.col("end")))
        .groupBy("id", "text_hash")
        .agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("found"))
    )


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, counts of known secrets, base_sha256 and spans of each row of docs.

    Null and empty texts have none. Rows that repeat get equal results, an empty
    table gives no rows; only doc_id and text are looked at. Long texts and long
    strings are scanned whole.
    """
    found = find_secrets(docs)
    rows = docs.select("doc_id", text_key().alias("key"))
    joined = rows.join(
        found, rows["doc_id"].eqNullSafe(found["id"]) & (rows["key"] == found["text_hash"]), "left"
    ).withColumn("found", F.coalesce("found", F.array()))

    def listed(which: str) -> Column:
        names = ", ".join(f"'{kind}'" for kind in KINDS)
        return F.expr(
            f"array_join(transform(filter(found, s -> {which}), "
            f"s -> concat_ws(':', array({names})[s.kind], s.start, s.end)), ',')"
        )

    counts = [
        F.expr(f"CAST(size(filter(found, s -> s.kind = {number})) AS BIGINT)").alias(f"n_{kind}")
        for number, kind in enumerate(KINDS[:3])
    ]
    return joined.select(
        "doc_id", *counts, F.sha2(listed("s.kind < 3").cast("binary"), 256).alias("base_sha256"), listed("true").alias("spans")
    )


def redact(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """docs with each secret in `text` replaced by a mark, overlapping ones by one.

    Null and empty texts, and texts without secrets, stay as they are. Rows that repeat get
    equal texts; an empty table gives no rows; other columns stay, whatever their names.
    """
    found = find_secrets(docs)
    id_, hash_, spans = free_names(docs, "id_of_found", "hash_of_found", "found")
    found = found.withColumnsRenamed({"id": id_, "text_hash": hash_, "found": spans})
    joined = docs.join(found, docs["doc_id"].eqNullSafe(found[id_]) & (text_key() == found[hash_]), "left")
    clean = F.expr(
        f"""aggregate(`{spans}`, named_struct('out', '', 'at', 0L),
          (a, s) -> CASE WHEN s.end <= a.at THEN a
                         WHEN s.start < a.at THEN named_struct('out', a.out, 'at', CAST(s.end AS BIGINT))
                         ELSE named_struct('out', concat(a.out, substr(`text`, a.at + 1, s.start - a.at), '{mark}'),
                                           'at', CAST(s.end AS BIGINT)) END,
          a -> concat(a.out, substr(`text`, a.at + 1)))"""
    )
    text = F.when(F.col(spans).isNull(), F.col("text")).otherwise(clean)
    return joined.withColumn("text", text).select(*docs.columns)


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
