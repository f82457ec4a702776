"""Landing rows to standard postings: whole-table jobs that add or rewrite columns, no shuffle anywhere."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import skills as S, text as T, times as X
from ..functions.automaton import SharedTerms
from ..functions.rules import GENERIC_CATEGORY_LABELS, GENERIC_CATEGORY_TAGS, PlaceRules, Vocabulary
from ..schema import POSTING

_STRINGS = "array<string>"


# Payload fields of both dialects. Nested values and tags of any shape are taken as JSON text.
_PAYLOAD = ("slug string, url string, title string, company_name string, company string, location string, "
            "description string, tags string, remote variant, created_at variant, created string, category string, "
            "contract_time string, contract_type string")
_NESTED = {"company": "display_name string", "location": "display_name string, area array<string>",
           "category": "label string, tag string"}


def _pick(is_aggregator: Column, aggregator: Column, board: Column) -> Column:
    return F.when(is_aggregator, aggregator).otherwise(board)


def _created(value: Column) -> Column:
    """Creation time as text: numbers, digits and times; text that only looks like a number is none of these."""
    shape, as_text = F.schema_of_variant(value), F.try_variant_get(value, "$", "string")
    odd = as_text.rlike(r"^\s*[+-]?[0-9]*\.?[0-9]+([eE][+-]?[0-9]+)?\s*$") & ~as_text.rlike(r"^\s*[0-9]+\s*$")
    number = (shape == "BIGINT") | (shape == "DOUBLE") | shape.startswith("DECIMAL")
    return F.when(number, as_text).when((shape == "STRING") & ~odd, as_text)


def flatten_payload(df: DataFrame, aggregator_sources: tuple[str, ...] = ()) -> DataFrame:
    """Two payload dialects to one flat set of columns; every payload is parsed once.

    Only JSON booleans say whether a posting is remote, and only JSON numbers, digits and ISO text when it was created.

    Sources named in `aggregator_sources` nest company, location and category; all others are flat boards.
    """
    agg = F.col("source").isin(*aggregator_sources) if aggregator_sources else F.lit(False)
    blank, c = F.lit(""), F.col
    df = df.withColumns({"is_aggregator": agg, "_p": F.from_json("raw_payload", _PAYLOAD)})
    df = df.withColumns({f"_{n}": F.from_json(F.when(c("is_aggregator"), c(f"_p.{n}")), schema)
                         for n, schema in _NESTED.items()})
    tag, label = F.lower(T.squash(T.text("_category.tag"))), T.squash(T.text("_category.label"))
    context = T.squash(F.concat_ws(
        " ", F.when(~tag.isin("", *GENERIC_CATEGORY_TAGS), F.replace(tag, F.lit("-"), F.lit(" "))),
        F.when(~F.lower(label).isin("", *GENERIC_CATEGORY_LABELS), label)))
    agg = c("is_aggregator")
    return df.withColumns({
        "title": F.btrim(T.text("_p.title")),
        "company": F.btrim(T.text(_pick(agg, c("_company.display_name"), c("_p.company_name")))),
        "location": F.btrim(_pick(agg, T.resolve_area("_location.display_name", "_location.area"),
                                  T.text("_p.location"))),
        "tags": _pick(agg, F.array().cast(_STRINGS), S.tag_list("_p.tags")),
        "slug": F.btrim(F.coalesce(F.nullif(T.text("source_slug"), blank), T.text("_p.slug"))),
        "description": F.btrim(T.text("_p.description")),
        "remote_flag": F.when(~agg & (F.schema_of_variant("_p.remote") == "BOOLEAN"), F.try_variant_get("_p.remote", "$", "boolean")),
        "category_tag": F.when(agg, tag), "category_label": F.when(agg, label),
        "category_context": F.when(agg, context).otherwise(blank),
        "contract": F.when(agg, F.concat_ws("\n", c("_p.contract_time"), c("_p.contract_type"))),
        "created_raw": _created(c("_p.created_at")), "created_iso": c("_p.created"),
    }).drop("_p", *[f"_{n}" for n in _NESTED])


def html_to_text(df: DataFrame, column: str, out: str, rare_entities: bool = True) -> DataFrame:
    return df.withColumn(out, T.html_to_text(column, rare_entities))


def normalize_titles(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
    return df.withColumn(out or column, T.normalize_title(column))


def enrich_titles(df: DataFrame, title: str = "title_norm", tag: str = "category_tag") -> DataFrame:
    return df.withColumn(title, T.enrich_title(title, tag))


def normalize_companies(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
    return df.withColumn(out or column, T.normalize_company(column))


def normalize_locations(df: DataFrame, column: str, out: str | None = None,
                        places: PlaceRules | None = PlaceRules()) -> DataFrame:
    return df.withColumn(out or column, T.normalize_location(column, places))


def canonicalize_places(df: DataFrame, column: str, places: PlaceRules, out: str | None = None) -> DataFrame:
    return df.withColumn(out or column, T.canonical_place(T.text(column), places))


def resolve_area(df: DataFrame, display: str, area: str, out: str) -> DataFrame:
    return df.withColumn(out, T.resolve_area(display, area))


def classify_work_mode(df: DataFrame, *texts: str, out: str = "remote_type", patterns=None) -> DataFrame:
    mode = T.work_mode(*texts, patterns=patterns) if patterns else T.work_mode(*texts)
    return df.withColumn(out, mode)


def parse_posted_at(df: DataFrame, raw: str, iso: str | None = None, out: str = "posted_at") -> DataFrame:
    return df.withColumn(out, X.posted_at(raw, iso))


def tag_skills(df: DataFrame, title: str, body: str, tags: str, context: str | None = None,
               vocab: Vocabulary = Vocabulary(), out: str = "skills", weak: Column | None = None) -> DataFrame:
    """Vocabulary tagging with a fixed vocabulary; rows where `weak` holds get the second pass."""
    ctx = F.col(context) if context else F.lit("")
    df = df.withColumn(out, S.extract_skills(F.col(tags), F.col(title), F.col(body), ctx, vocab))
    if weak is None:
        return df
    more = S.enrich_weak(F.col(out), F.col(title), F.col(body), ctx, vocab)
    return df.withColumn(out, F.when(weak, more).otherwise(F.col(out)))


#: Vocabularies up to this many terms and bytes of text are sent to the tasks as an automaton; larger ones are joined.
AUTOMATON_TERMS, AUTOMATON_BYTES = 200_000, 8_000_000


def tag_terms(df: DataFrame, vocab: DataFrame, key: str, body: str, term: str = "term", canonical: str | None = None,
              max_words: int | None = None, out: str = "skills", unique_key: bool = False) -> DataFrame:
    """Tagging with a vocabulary that is a table of any size: (key, sorted distinct terms), empty when none.

    One aggregate tells the size of the vocabulary. Up to AUTOMATON_TERMS and AUTOMATON_BYTES it goes to the tasks, which
    build an automaton from it once and read each text once (`find_terms`); a larger one is joined (`join_terms`). Rows
    are the same. A term of more than `max_words` words fails the query. `unique_key=True` says keys do not repeat: texts
    then pass through the automaton without a shuffle.
    """
    size = vocab.agg(F.count(term).alias("n"), F.sum(F.octet_length(F.concat_ws(" ", term, canonical or term))).alias("bytes")).first()
    if size["n"] <= AUTOMATON_TERMS and (size["bytes"] or 0) <= AUTOMATON_BYTES:
        return find_terms(df, vocab, key, body, term, canonical, max_words, out, unique_key)
    return join_terms(df, vocab, key, body, term, canonical, max_words, out)


def find_terms(df: DataFrame, vocab: DataFrame, key: str, body: str, term: str = "term", canonical: str | None = None,
               max_words: int | None = None, out: str = "skills", unique_key: bool = False, longest: bool = False) -> DataFrame:
    """`tag_terms` by an Aho-Corasick automaton over words, for vocabularies of bounded size.

    Words with edge marks count without them as well, as terms of one word. `longest=True` leaves out what occurs only
    inside longer terms.
    """
    names: dict[str, list[str]] = {}
    for row in vocab.where(F.col(term).isNotNull()).select(F.col(term).alias("t"), F.col(canonical or term).alias("c")).distinct().collect():
        if max_words is not None and row["t"].count(" ") >= max_words:
            raise ValueError(f"vocabulary term of more than {max_words} words: {row['t']}")
        if row["c"] is not None:
            names.setdefault(row["t"], []).append(row["c"])
    shared = df.sparkSession.sparkContext.broadcast(SharedTerms(names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value.automaton  # built once per worker
        names, numbers, seek = shared.value.names, automaton.number, automaton.longest if longest else automaton.all
        for batch in batches:
            tags = []
            for text in batch.column(1).to_pylist():
                words = text.split(" ")
                hits = {automaton.terms[i] for i in seek(words)}
                for word in set(words):
                    if word and (word[0] in S.TOKEN_EDGE or word[-1] in S.TOKEN_EDGE):
                        bare = word.strip(S.TOKEN_EDGE)
                        if len(bare) >= 2 and bare in numbers:
                            hits.add(bare)
                tags.append(sorted({name for hit in hits for name in names[hit]}, key=str.encode))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(tags, pa.list_(pa.string()))], [key, out])

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(key, S.token_text(body).alias("_text")).mapInArrow(run, f"`{key}` {kind}, `{out}` array<string>")
    if unique_key:
        return rows
    each = rows.select(key, F.explode_outer(out).alias("_t"))
    return each.groupBy(key).agg(F.array_sort(F.collect_set("_t")).alias(out))


def join_terms(df: DataFrame, vocab: DataFrame, key: str, body: str, term: str = "term", canonical: str | None = None,
               max_words: int | None = None, out: str = "skills") -> DataFrame:
    """`tag_terms` by a join, for vocabularies of any size.

    Distinct n-grams per text meet the vocabulary in one equi-join on the term. Nothing is broadcast by hand:
    AQE broadcasts a vocabulary it measured as small and splits hot terms of a large one. Only the key, not
    the text, passes through the closing grouping, which also brings back the texts without a hit.

    n-grams go up to the longest term, found by one aggregate over the vocabulary while the plan is built; with
    `max_words` that job is saved, and a longer term fails the query.
    """
    term_words = F.size(F.split(F.col(term), " "))
    if max_words is None:
        max_words = vocab.agg(F.max(term_words)).first()[0] or 1
        checked = F.col(term)
    else:
        checked = F.when(term_words <= max_words, F.col(term)).otherwise(F.raise_error(F.concat(
            F.lit(f"vocabulary term of more than {max_words} words: "), F.col(term))).cast("string"))

    def grams(tokens: Column) -> Column:
        sizes = [tokens]
        for n in range(1, max_words):
            # (n+1)-grams: every n-gram but the last, next to the token that follows it
            sizes.append(F.zip_with(F.slice(sizes[-1], 1, F.greatest(F.size(tokens) - n, F.lit(0))),
                                    F.slice(tokens, n + 1, F.greatest(F.size(tokens) - n, F.lit(0))),
                                    lambda left, right: F.concat_ws(" ", left, right)))
        return F.filter(F.array_distinct(F.concat(S.bare_tokens(tokens), *sizes)), lambda g: g != "")

    name = canonical or term
    words = vocab.where(F.col(term).isNotNull()).select(checked.alias("_g"), F.col(name).alias("_t")).distinct()
    hits = (df.select(key, F.explode(T.let(F.split(S.token_text(body), " "), grams)).alias("_g")).join(words, "_g")
            .select(key, "_t"))
    every = df.select(key, F.lit(None).cast("string").alias("_t"))
    return hits.unionByName(every).groupBy(key).agg(F.array_sort(F.collect_set("_t")).alias(out))


def project_contract(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Exactly the posting columns in contract order; missing ones are NULL (skills: empty), extras go.

    `keep` lets working columns (such as the line order of a batch) ride along behind the contract.
    """
    types = dict(df.dtypes)

    def column(name: str, kind) -> Column:
        if name == "skills":
            if name not in types:
                return F.array().cast(_STRINGS)
            if types[name] == "string":
                return S.skills_from_json(name)
            kept = F.filter(F.transform(name, lambda s: F.btrim(T.text(s))), lambda s: s != "")
            return F.coalesce(kept, F.array().cast(_STRINGS))
        if name not in types:
            return F.lit(None).cast(kind)
        if name == "posted_at" and types[name] == "string":
            return X.stored_time(name, False)
        return F.col(name).cast(kind)

    return df.select(*[column(f.name, f.dataType).alias(f.name) for f in POSTING.fields], *keep)


def text_contract(df: DataFrame) -> DataFrame:
    """The contract at the storage boundary: every column text, skills as JSON, times as ISO UTC."""
    out = project_contract(df)
    return out.withColumns({"skills": S.skills_to_json("skills"),
                            "posted_at": F.date_format("posted_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")})


def align_legacy(df: DataFrame, places: PlaceRules | None = PlaceRules()) -> DataFrame:
    """Rows of an earlier layout in the posting contract, titles and locations normalised again.

    Earlier names stand in, row by row, where the contract column is missing or NULL, so files of several
    layouts may be read together with merged schemas.
    """
    def old(name: str, convert=lambda c: c) -> list[Column]:
        return [convert(F.col(name))] if name in df.columns else []

    def key_or_null(c: Column) -> Column:
        k = F.btrim(T.text(c))
        return F.when((k != "") & ~F.lower(k).startswith("http"), k)

    def known(c: Column, value: Column) -> Column:
        return F.when(c.isNotNull(), value)

    blank = F.lit("")
    title = (old("title_norm") + old("title_raw") + old("title", lambda c: F.nullif(c, blank)) + old("title_clean"))
    company = (old("company_norm") + old("company_raw", lambda c: known(c, T.normalize_company(c)))
               + old("company_name", lambda c: known(c, T.squash(F.lower(c)))))
    mode = old("remote_type") + old("is_remote", lambda c: known(c, T.work_mode_flag(c.cast("boolean"))))
    posted = old("posted_at") + old("published_at_raw")
    new = {
        "title_norm": T.normalize_title(F.coalesce(*title, blank)),
        "company_norm": F.coalesce(*company, blank),
        "location_raw": T.normalize_location(F.coalesce(*old("location_raw"), *old("location"), blank), places),
        "remote_type": F.coalesce(*mode, F.lit("unknown")),
        "source_job_id": F.coalesce(*old("source_job_id"), *old("source_record_key", key_or_null),
                                    F.lit(None).cast("string"))}
    if posted:
        new["posted_at"] = F.coalesce(*posted)
    return project_contract(df.withColumns(new))


def standardize(df: DataFrame, aggregator_sources: tuple[str, ...] = (), vocab: Vocabulary = Vocabulary(),
                places: PlaceRules | None = PlaceRules(), rare_entities: bool = True,
                keep: tuple[str, ...] = ()) -> DataFrame:
    """Landing rows to postings in the contract; one narrow stage over the whole table."""
    flat = flatten_payload(df, aggregator_sources)
    flat = html_to_text(flat, "description", "body", rare_entities)
    flat = tag_skills(flat, "title", "body", "tags", "category_context", vocab, weak=F.col("is_aggregator"))
    agg = F.col("is_aggregator")
    base = T.normalize_title("title")
    sid = F.nullif(F.btrim(_pick(agg, T.text("source_job_id"), F.col("slug"))), F.lit(""))
    inferred = T.work_mode("title", "body", "category_label", "category_tag", "contract")
    ready = flat.select(
        "job_id", "source", sid.alias("source_job_id"),
        _pick(agg, T.enrich_title(base, "category_tag"), base).alias("title_norm"),
        T.normalize_company("company").alias("company_norm"),
        T.normalize_location("location", places).alias("location_raw"),
        _pick(agg, inferred, T.work_mode_flag("remote_flag")).alias("remote_type"), "skills",
        X.posted_at("created_raw", "created_iso").alias("posted_at"), "ingested_at", "job_id_strategy",
        F.col("run_id").alias("bronze_run_id"), "bronze_ingest_date",
        *(["bronze_data_file"] if "bronze_data_file" in df.columns else []), *keep)
    return project_contract(ready, keep)
