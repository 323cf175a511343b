from __future__ import annotations

import random

from quartier.llm import language

WORDS = {
    "en": "the and of to in that was for with this from have which not are".split(),
    "de": "der die und das nicht ein ist mit auf für werden auch über schön".split(),
    "fr": "le la les des est une que pour dans avec être où très leur".split(),
}


def text(lang: str, n: int, pick: random.Random) -> str:
    return " ".join(pick.choices(WORDS[lang], k=n))


def rows(n: int = 300):
    pick = random.Random(3)
    for i in range(n):
        lang = ["en", "en", "de", "fr"][i % 4]
        yield i, text(lang, pick.randint(5, 60), pick), lang, f"s{i % 5}", "?", "?"


SCHEMA = "doc_id long, text string, lang string, source string, key string, accepted string"


def test_documents_get_their_language(spark):
    docs = spark.createDataFrame([*rows()], SCHEMA)
    odd = [(900, None, "en", "s1", "?", "?"), (901, "", None, None, "?", "?"), (902, "12 34 !?", "en", "s1", "?", "?"),
           (None, "the and of to in that", None, None, "?", "?"), (903, "zqx xqz kkzx qqq " * 20, None, "s1", "?", "?"),
           (904, "the and of " * 30000, "xx", "s9", "?", "?")]
    model = language.fit(docs)
    assert model.languages == ("de", "en", "fr")
    got = {r.key: r for r in language.identify_documents(docs.union(spark.createDataFrame(odd, SCHEMA)), model).collect()}
    want = {i: lang for i, _, lang, *_ in rows()}
    assert len(got) == 306
    assert all(got[i].lang == lang and got[i].accepted for i, lang in want.items())
    assert [got[k].accepted for k in (900, 901, 902, 903)] == [False] * 4 and got[900].lang is None
    assert got[None].lang == "en" and got[904].lang == "en"
    again = language.identify_documents(docs.union(docs), model)
    assert again.count() == 600
    assert language.identify_documents(docs.limit(0), model).count() == 0


def test_no_labels_means_nothing_is_accepted(spark):
    docs = spark.createDataFrame([*rows(20)], SCHEMA)
    model = language.fit(docs.limit(0))
    got = language.identify_documents(docs, model).collect()
    assert len(got) == 20 and not any(r.accepted for r in got)


def test_hosts_and_markup_decide_where_the_text_does_not(spark):
    pick = random.Random(4)
    model = language.fit(spark.createDataFrame([*rows()], SCHEMA))

    def page(lang, body):
        return f'<!doctype html><html class="x" lang="{lang}-XX"><style>p{{}}</style><body><p>{body}</p><script>the and</script>'

    pages = [(i, f"http://www.seite{i % 3}.de/{i}", page("de", text("de", 30, pick)), "?") for i in range(60)]
    pages += [(100 + i, f"https://site{i % 3}.com/{i}", page("en", text("en", 30, pick)), "?") for i in range(60)]
    pages += [(200, "http://www.seite1.de/x", page("de", "in"), "?"), (201, "https://site1.com/x", page("en", "in"), "?")]
    pages += [(300, None, None, "?"), (301, "not an address", "<p>" + text("fr", 30, pick), "?"), (302, "", "", "?")]
    got = {r.key: r for r in language.identify_pages(spark.createDataFrame(pages, "page_id long, url string, html string, host string"), model).collect()}
    assert len(got) == len(pages)
    assert all(got[i].lang == "de" and got[100 + i].lang == "en" for i in range(60))
    assert got[200].lang != "en" and got[201].lang == "en"  # one text, but other evidence
    assert got[301].lang == "fr" and got[301].declared == "none" and not got[300].accepted and not got[302].accepted


def test_rare_languages_are_in_the_model_of_a_large_table(spark):
    """Three documents of one language among many, and a hot group of copies: both must leave every language its rows."""
    pick = random.Random(6)
    docs = [(i, text("en", 20, pick), "en", "s", "?", "?") for i in range(3000)]
    docs += [(10000 + i, text("de", 20, pick), "de", "s", "?", "?") for i in range(3)]
    docs += [(20000 + i, "le la les des est une que pour", "fr", "s", "?", "?") for i in range(500)]
    table = spark.createDataFrame(docs, SCHEMA)
    model = language.fit(table, rows=40)
    assert model.languages == ("de", "en", "fr")
    got = {r.key: r for r in language.identify_documents(table, model).collect()}
    assert all(got[i].lang == lang and got[i].declared == lang for i, _, lang, *_ in docs)


def test_every_label_is_in_the_model(spark):
    docs = [(i, f"{chr(97 + i % 26) * 3} {chr(97 + i // 26) * 4}", f"l{i}", "s", "?", "?") for i in range(260)]
    assert language.fit(spark.createDataFrame(docs, SCHEMA), rows=50).languages == tuple(sorted(f"l{i}" for i in range(260)))


def test_sample_shares_fill_the_rows():
    shares = language.sample_shares({"en": 10**9, "de": 10**6, "sw": 3}, 20_000)
    assert shares["sw"] == 1 and round(shares["de"] * 10**6) == 9998 and round(shares["en"] * 10**9) == 9999


def test_declared_language_is_found_in_the_whole_page():
    root, long = '<html class="x" lang="de-AT"><body>', "licence " * 2000
    assert language.declared(f"<!-- {long} -->{root}") == "de"
    assert language.declared(f"<?xml version='1.0'?>{' ' * 5000}<!doctype html>{root}") == "de"
    assert language.declared(f'<!-- <html lang="fr"> {long} --><script>"<html lang=en>"</script>{root}') == "de"
    assert language.declared('<!-- <html lang="fr"> --><html><body>') is None
    assert language.declared("<html " * 200_000) is None and language.declared(None) is None
