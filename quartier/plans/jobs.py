"""The jobs that stage the star schema. Each reads its inputs once and writes whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartier.operators import checks, dims, facts
from quartier.operators.numbering import extended_keys
from quartier.plans.mart import Mart, Store
from quartier.session import cut_lineage
from quartier.sources import files

# Staged copies of inputs that several jobs read, records set aside, and key maps (fixed names).
BUSINESS_SOURCE, REVIEW_SOURCE = "business_source", "review_source"
TIP_SOURCE, CHECKIN_SOURCE = "tip_source", "checkin_source"
BUSINESS_REJECTS, TIP_REJECTS, CHECKIN_REJECTS = "business_rejects", "tip_rejects", "checkin_rejects"
LOCATION_KEYS, CATEGORY_KEYS = "location_keys", "category_keys"


def _without_business(business: DataFrame) -> DataFrame:
    """Records of any source in the shape of a checked read: those without a business are set aside."""
    if files.REASON in business.columns:
        return business
    lacking = F.col("business_id").isNull()
    return business.withColumns({
        files.REASON: F.when(lacking, F.lit("no business_id")),
        files.TEXT: F.when(lacking, F.to_json(F.struct("*"))),
    })


def _keys(natural: DataFrame, column: str, key: str, name: str, store: Store) -> DataFrame:
    """The stored key map ``name``, extended by new values and kept: it is saved with the dimensions."""
    return cut_lineage(extended_keys(natural, store.load_if_there(name), column, key))


def build_dimensions(business: DataFrame, store: Store, dense_keys: bool = False) -> None:
    """Stage location, business, category and bridge.

    The business records are staged first, so that a text source is parsed once and the four tables read only their
    columns. Records set aside by a checked read, and those without a business, go to ``BUSINESS_REJECTS`` as (source, reason, text),
    and to no dimension.

    Keys are hashes of the natural keys. With ``dense_keys`` they count 1, 2, 3, ... without gaps and stay over further
    loads: the maps ``LOCATION_KEYS`` and ``CATEGORY_KEYS`` are stored with the tables and extended by what is new, so no two
    values can collide however many there are.

    Keys are checked on the staged records, before any table is replaced: hashes because they can collide, and all because the
    reports take one location per business for granted.
    """
    store.save(_without_business(business), BUSINESS_SOURCE)
    staged = store.load(BUSINESS_SOURCE)
    source = files.accepted(staged)
    location_keys = category_keys = None
    if dense_keys:
        checks.require_unique(source, "business_id")
        location_keys = _keys(source, "business_id", "location_id", LOCATION_KEYS, store)
        category_keys = _keys(dims.category_names(source), "category_name", "category_id", CATEGORY_KEYS, store)
    location, category = dims.location_dim(source, location_keys), dims.category_dim(source, category_keys)
    if not dense_keys:
        checks.require_unique(location, "location_id")
        checks.require_unique(category, "category_id")
    store.save(files.rejects(staged, "business"), BUSINESS_REJECTS)
    if location_keys is not None and category_keys is not None:
        store.save(location_keys, LOCATION_KEYS)
        store.save(category_keys, CATEGORY_KEYS)
    store.save(location, "location")
    store.save(dims.business_dim(source), "business")
    store.save(category, "category")
    if dense_keys:
        store.save(dims.keyed_business_category(source, store.load("category")), "business_category")
    else:
        store.save(dims.business_category(source), "business_category")


def stage_reviews(reviews: DataFrame, store: Store) -> DataFrame:
    """Copy the reviews out of their database once; calendar and fact read the copy."""
    store.save(reviews.select("review_id", "business_id", "date", "stars"), REVIEW_SOURCE)
    return store.load(REVIEW_SOURCE)


def build_calendar(reviews: DataFrame, store: Store) -> None:
    """Stage the calendar: the months that have a review."""
    store.save(dims.month_dim(reviews, "date"), "calendar")


def set_aside(checked: DataFrame, source: str, rejects: str, label: str, store: Store) -> DataFrame:
    """The good records of a checked read, staged once as ``source``; the others are staged as ``rejects``."""
    store.save(checked, source)
    staged = store.load(source)
    store.save(files.rejects(staged, label), rejects)
    return files.accepted(staged)


def build_fact(reviews: DataFrame, tips: DataFrame, checkins: DataFrame, store: Store) -> None:
    """Stage the fact over the staged locations and calendar.

    Tips and check-ins that were read with checks are staged first, without what the fact does not use, and the records
    set aside go to ``TIP_REJECTS`` and ``CHECKIN_REJECTS``. Checked check-ins hold all dates of a business in one text.
    """
    if files.REASON in tips.columns:
        tips = set_aside(tips.select("business_id", "date", files.REASON, files.TEXT), TIP_SOURCE, TIP_REJECTS, "tips", store)
    if files.REASON in checkins.columns:
        checkins = dims.split_dates(set_aside(checkins, CHECKIN_SOURCE, CHECKIN_REJECTS, "checkins", store))
    fact = facts.performance_fact(reviews, tips, checkins, store.load("location"), store.load("calendar"))
    store.save(fact, "performance_fact")


def build_mart(
    business: DataFrame, reviews: DataFrame, tips: DataFrame, checkins: DataFrame, store: Store, dense_keys: bool = False
) -> Mart:
    """All jobs in order."""
    build_dimensions(business, store, dense_keys)
    reviews = stage_reviews(reviews, store)
    build_calendar(reviews, store)
    build_fact(reviews, tips, checkins, store)
    return store.mart()
