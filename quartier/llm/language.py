"""Language of texts and pages by Bayesian evidence fusion.

Three kinds of evidence are multiplied: how likely the text is in each language (letter trigrams, learnt from labelled
documents), how often pages of each language declare what this one declares, and the prior of the host. A host's prior is
smoothed toward its domain's, that toward the address suffix's, and that toward the whole table's; all levels are counts of
text posteriors, made by grouped aggregation, and a row's own count is taken out of its host's. A row is accepted if its
text has letters, is about as likely as texts of its language usually are, and one language has most of the posterior.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartier.llm.arrow import map_rows
from quartier.session import cut_lineage

#: Labelled rows that the text model is fitted on, and the fewest of a language that has as many; both but for chance.
TRAIN_ROWS = 20_000
LEAST_ROWS = 100
#: Trigrams are counted in this many classes.
CLASSES = 1 << 14
#: Trigrams overlap, so a text counts as this many independent ones at most.
INDEPENDENT = 60.0
#: Rows of its parent that a level of the host's prior starts from.
WEIGHT = 8.0
#: Accepted with this posterior at least, and a mean log likelihood of trigrams this far (and four deviations of a text of
#: its length) below its language's texts at most.
SURE = 0.6
UNUSUAL = 1.5

_LETTERS = bytes(b if b >= 128 or 97 <= b < 123 else b + 32 if 65 <= b < 91 else 32 for b in range(256))


def trigrams(text: str | None) -> np.ndarray:
    """Class of each letter trigram, with one space for each run of other characters; none without a letter."""
    parts = (text or "").encode("utf-8", "surrogatepass").translate(_LETTERS).split()
    if not parts:
        return np.zeros(0, dtype=np.int64)
    raw = np.frombuffer(b" " + b" ".join(parts) + b" ", np.uint8).astype(np.uint32)
    code = (raw[:-2] << np.uint32(16)) | (raw[1:-1] << np.uint32(8)) | raw[2:]
    return ((code * np.uint32(2654435761)) >> np.uint32(18)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    likelihood: np.ndarray  # class x language, logarithms
    usual: np.ndarray  # mean of a text's mean logarithm, by language
    spread: np.ndarray  # its deviation for a text of one trigram, by language

    def read(self, text: str | None) -> tuple[int, list[float]]:
        """Number of trigrams; mean log likelihood of one, by language."""
        found = trigrams(text)
        if not len(found) or not self.languages:
            return 0, [0.0] * len(self.languages)
        return len(found), [float(x) for x in self.likelihood[found].mean(axis=0, dtype=np.float64)]


def sample_shares(sizes: dict[str, int], rows: int) -> dict[str, float]:
    """The share of each language's texts that is learnt from: all of small ones, the rest of ``rows`` evenly to others."""
    shares = {}
    for k, (lang, size) in enumerate(sorted(sizes.items(), key=lambda x: (x[1], x[0]))):
        own = max(LEAST_ROWS, rows // (len(sizes) - k))
        shares[lang] = min(1.0, own / max(size, 1))
        rows = max(0, rows - min(size, own))
    return shares


def fit(docs: DataFrame, rows: int = TRAIN_ROWS, text_col: str = "text", lang_col: str = "lang") -> Model:
    """A text model of every label in ``docs``, from about ``rows`` distinct labelled documents in all.

    Labels are counted over all rows; each then gives its texts of least hash, as many as ``sample_shares`` says, so a rare
    language is in the model whatever the size of the table. Null texts and labels are left out. Without any, the model has
    no language and nothing is accepted.
    """
    known = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    known = known.where("lang IS NOT NULL AND text IS NOT NULL").withColumn("h", F.xxhash64("text", "lang"))
    sizes = {r.lang: r.n for r in known.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()}
    languages = tuple(sorted(sizes))
    if not languages:
        return Model((), np.zeros((CLASSES, 0), np.float32), np.zeros(0), np.zeros(0))
    shares = docs.sparkSession.createDataFrame([*sample_shares(sizes, rows).items()], "lang string, share double")
    low = F.col("h") / 2.0**64 + 0.5 <= F.col("share")
    train = cut_lineage(known.join(F.broadcast(shares), "lang").where(low).select("lang", "text").distinct())

    def count():
        def step(langs: list, texts: list) -> Iterator[tuple]:
            for lang in set(langs):
                own = [trigrams(t) for k, t in zip(langs, texts) if k == lang]
                counts = np.bincount(np.concatenate(own), minlength=CLASSES)
                yield from ((lang, int(c), int(counts[c])) for c in np.flatnonzero(counts))

        return step

    counted = map_rows(train, "lang string, class int, n long", count).groupBy("lang", "class").agg(F.sum("n").alias("n"))
    table = np.full((CLASSES, len(languages)), 0.5)
    place = {lang: i for i, lang in enumerate(languages)}
    for r in counted.collect():  # CLASSES for each language at most
        table[r["class"], place[r.lang]] += r.n
    likelihood = np.log(table / table.sum(axis=0)).astype(np.float32)

    def measure():
        def step(langs: list, texts: list) -> Iterator[tuple]:
            for lang, text in zip(langs, texts):
                found = trigrams(text)
                if len(found):
                    yield lang, len(found), float(likelihood[found, place[lang]].mean(dtype=np.float64))

        return step

    fits = map_rows(train, "lang string, n long, mean double", measure)
    of = fits.groupBy("lang").agg(
        F.avg("mean").alias("usual"), F.avg(F.col("mean") ** 2).alias("square"), F.avg(1 / F.col("n")).alias("inverse")
    )
    usual, spread = np.full(len(languages), -9.0), np.full(len(languages), 9.0)
    for r in of.collect():
        usual[place[r.lang]] = r.usual
        spread[place[r.lang]] = max(0.05, (max(r.square - r.usual**2, 0.0) / r.inverse) ** 0.5)
    return Model(languages, likelihood, usual, spread)


_SCRIPT = re.compile(r"<(script|style|noscript|template)\b.*?(?:</\1\s*>|\Z)|<!--.*?(?:-->|\Z)", re.S | re.I)
_TAG = re.compile(r"<[^>]*(?:>|\Z)")
_ROOT = re.compile(r"<html\b[^>]*", re.I)
_DECLARED = re.compile(r"\blang\s*=\s*[\"']?\s*([A-Za-z]{2,8})", re.I)


def visible(page: str | None) -> str:
    """The text of a page without scripts, styles, comments and tags."""
    return html.unescape(_TAG.sub(" ", _SCRIPT.sub(" ", page or "")))


def declared(page: str | None) -> str | None:
    """Primary part of the language that the page's root element declares, wherever it stands outside scripts and comments."""
    tags = _ROOT.finditer(_SCRIPT.sub(" ", page or ""))
    found = next(filter(None, (_DECLARED.search(tag[0]) for tag in tags)), None)
    return found[1].lower() if found else None


def address_columns(url: str) -> dict[str, Column]:
    """Host, domain (its last two names) and suffix (its last name) of an address; null where there is none."""
    host = F.lower(F.nullif(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1), F.lit("")))
    return {"host": host, "domain": F.substring_index(host, ".", -2), "suffix": F.substring_index(host, ".", -1)}


def page_rows(pages: DataFrame, model: Model, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """Evidence of pages, for ``fuse``."""
    rows = pages.select(F.col(key).cast("long"), F.col(page).cast("string"), *address_columns(url).values())
    return _evidence(rows, model, visible, lambda text, told: declared(text))


def document_rows(
    docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", told: str = "lang", host: str = "source",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Evidence of documents, for ``fuse``: the language column is what is declared, the source is the host.

    The columns of ``docs`` named in ``keep`` come along.
    """
    none = F.lit(None).cast("string")
    columns = [F.col(key).cast("long"), F.col(text).cast("string"), F.col(host).cast("string"), none, none]
    rows = docs.select(*columns, F.lower(F.col(told).cast("string")), *keep)
    return _evidence(rows, model, lambda t: t, lambda t, d: d, keep)


def _evidence(rows: DataFrame, model: Model, text_of, declared_of, keep: Sequence[str] = ()) -> DataFrame:
    def work():
        def step(keys: list, texts: list, hosts: list, domains: list, suffixes: list, told: list = ()) -> Iterator[tuple]:
            for k, (key, text) in enumerate(zip(keys, texts)):
                n, means = model.read(text_of(text))
                said = declared_of(text, told[k] if told else None)
                said = said if said is None or said in model.languages else "other"
                fits = [m >= u - UNUSUAL - 4 * s / n**0.5 for m, u, s in zip(means, model.usual, model.spread)] if n else []
                scaled = np.array(means) * (n * INDEPENDENT / (n + INDEPENDENT))
                share = np.exp(scaled - scaled.max()) if len(scaled) else scaled
                share = (share / share.sum()).tolist() if n else [1 / max(len(means), 1)] * len(means)
                yield key, hosts[k], domains[k], suffixes[k], said or "none", n, share, fits or [False] * len(means)

        return step

    schema = (
        "_key long, _host string, _domain string, _suffix string, _declared string, _n long, _share array<double>, "
        "_fits array<boolean>"
    )
    return map_rows(rows, schema, work, keep)


def _mixed(own: Column, n: Column, parent: Column) -> Column:
    """Shares of a level: its own counts, and ``WEIGHT`` rows of its parent's shares."""
    return F.zip_with(own, parent, lambda c, p: (F.greatest(c, F.lit(0.0)) + WEIGHT * p) / (n + WEIGHT))


def fuse(evidence: DataFrame, model: Model, keep: Sequence[str] = ()) -> DataFrame:
    """(key, lang, posterior, text_lang, declared, accepted) of every row of ``evidence``, which is read twice.

    Columns named in ``keep`` come along, and take the place of those with their names.

    ``lang`` is null where the row is not accepted: texts without letters, empty or null, that look like no known language,
    or that leave several languages likely. Null hosts share the prior of the whole table. Repeated rows stay.
    """
    size = len(model.languages)
    plain = [name for name in ("key", "lang", "posterior", "text_lang", "declared", "accepted") if name not in keep]
    if not size:
        none = {"lang": F.lit(None).cast("string"), "posterior": F.lit(0.0), "text_lang": F.lit(None).cast("string"), "accepted": F.lit(False)}
        none |= {"key": F.col("_key"), "declared": F.col("_declared")}
        return evidence.select(*(none[name].alias(name) for name in plain), *keep)
    names = F.array(*map(F.lit, model.languages))
    some = evidence.where("_n > 0")
    sums = [F.sum(F.col("_share")[i]).alias(f"s{i}") for i in range(size)]
    again = [F.sum(f"s{i}").alias(f"s{i}") for i in range(size)]
    counts = F.array(*(F.coalesce(F.col(f"s{i}"), F.lit(0.0)) for i in range(size)))

    # One row for each declared value (the languages, other, none): P(declared | language).
    said = some.groupBy("_declared").agg(*sums).collect()
    total = np.array([[r[f"s{i}"] for i in range(size)] for r in said]).reshape(-1, size)
    kinds = size + 2
    chance = {r._declared: np.log((row + 1.0) / (total.sum(axis=0) + kinds)).tolist() for r, row in zip(said, total)}
    whole = total.sum(axis=0)
    overall = ((whole + 1.0) / (whole.sum() + size)).tolist()
    spoken = evidence.sparkSession.createDataFrame([*chance.items()], "_declared string, log_said array<double>")

    hosts = some.where("_host IS NOT NULL").groupBy("_host", "_domain", "_suffix").agg(*sums, F.count(F.lit(1)).alias("rows"))
    hosts = cut_lineage(hosts)
    domains = hosts.where("_domain IS NOT NULL").groupBy("_domain", "_suffix").agg(*again, F.sum("rows").alias("rows"))
    suffixes = domains.groupBy("_suffix").agg(*again, F.sum("rows").alias("rows"))
    root = F.array(*map(F.lit, overall))
    top = suffixes.select("_suffix", _mixed(counts, F.col("rows"), root).alias("of_suffix"))
    middle = domains.join(top, "_suffix").select("_domain", _mixed(counts, F.col("rows"), F.col("of_suffix")).alias("of_domain"))
    near = hosts.join(middle, "_domain", "left").select(
        "_host", counts.alias("of_host"), F.col("rows").alias("host_rows"), F.coalesce("of_domain", root).alias("parent")
    )

    # A hot host's rows meet one row of ``near``: the adaptive skew join splits them.
    joined = evidence.join(near, "_host", "left").join(F.broadcast(spoken), "_declared", "left")
    others = F.zip_with("of_host", "_share", lambda c, own: c - own)
    prior = F.when(F.col("host_rows").isNotNull() & (F.col("_n") > 0), _mixed(others, F.col("host_rows") - 1, F.col("parent")))
    log_said = F.coalesce("log_said", F.array(*[F.lit(0.0)] * size))
    fused = F.zip_with(F.zip_with("_share", F.coalesce(prior, root), lambda s, p: F.log(s + 1e-300) + F.log(p)), log_said, lambda a, b: a + b)
    joined = joined.withColumn("_log", fused)
    best = F.array_max("_log")
    joined = joined.withColumn("_all", F.aggregate("_log", F.lit(0.0), lambda a, x: a + F.exp(x - best)))
    at, text_at = F.array_position("_log", best).cast("int"), F.array_position("_share", F.array_max("_share")).cast("int")
    posterior = F.round(F.when(F.col("_n") > 0, 1 / F.col("_all")).otherwise(0.0), 6)
    joined = joined.withColumns({"_posterior": posterior, "_best": at, "_text": text_at})
    accepted = (F.col("_n") > 0) & (F.col("_posterior") >= SURE) & F.element_at("_fits", F.col("_best"))
    out = {
        "key": F.col("_key"), "posterior": F.col("_posterior"), "declared": F.col("_declared"), "accepted": accepted,
        "lang": F.when(accepted, F.element_at(names, F.col("_best"))),
        "text_lang": F.when(F.col("_n") > 0, F.element_at(names, F.col("_text"))),
    }
    return joined.select(*(out[name].alias(name) for name in plain), *keep)


def identify_documents(docs: DataFrame, model: Model, **columns: str) -> DataFrame:
    """The fused languages of documents, keyed by their id. Runs when called: the evidence is kept as a table."""
    return fuse(cut_lineage(document_rows(docs, model, **columns)), model)


def identify_pages(pages: DataFrame, model: Model, **columns: str) -> DataFrame:
    """The fused languages of pages, keyed by their id. Runs when called: the evidence is kept as a table."""
    return fuse(cut_lineage(page_rows(pages, model, **columns)), model)
