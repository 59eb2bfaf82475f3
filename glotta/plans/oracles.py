"""The registered queries as plain SQL over the same tables, for cross-checking.

Written from the definitions, with another engine's functions and its own route
to the result (plain windows, unnest and group-by), so that a mistake in an
operator does not repeat itself here.
"""

from __future__ import annotations

import sys
from collections.abc import Callable

from glotta import SEED
from glotta.functions import stemming as st
from glotta.functions.lexicons import (ENGLISH_MODEL_NAME, ENGLISH_TARGET_PREFIX, MODEL_NAME, SPANISH_FORMS,
                                       SUPPORTED_LANGUAGES, TO_SPANISH)
from glotta.functions.tagging import DEFAULT_POS, POS_RULES
from glotta.resources import spanish_stopwords


def _q(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(_q(v) for v in row) + ")" for row in rows)


# The cleaning and token patterns, as in the operators.
W = r"[\p{L}\p{N}_]"
URL = (r"https?://(www\.)?[-a-zA-Z0-9@:%._+~#=]{1,256}\.[a-zA-Z0-9()]{1,6}\b"
       r"([-a-zA-Z0-9()@:%_+.~#?&/=]*)")


def _sub(text: str, pattern: str, replacement: str = "") -> str:
    return f"regexp_replace({text}, {_q(pattern)}, {_q(replacement)}, 'g')"


def _pixels(t):
    return _sub(t, r"[0-9]+px\|?")


def _box(t):
    return _sub(t, rf"{W}+\s?=\s?{W}*|\|")


def _long(t):
    return _sub(t, W + "{40,}")


def _urls(t):
    return _sub(t, URL)


def _tokens(t):
    return f"regexp_extract_all({t}, {_q(rf'{W}+|[^' + W[1:-1] + r'\s]')})"


CORPUS = "corpus as (select source as context, lang as language, cast(doc_id as varchar) as docname, text from documents)"
CLEANED = (f"{CORPUS}, cleaned as (select context, language, docname, "
           f"{_urls(_long(_box(_pixels('text'))))} as cleaned_text from corpus)")


def _with(ctes: str, query: str) -> str:
    return f"with {ctes} {query}"


def _normalized() -> str:
    """Distinct lower-cased tokens without stop words, one row per token."""
    stop = ", ".join(f"({_q(w)})" for w in spanish_stopwords())
    return (f"{CLEANED}, stop(word) as (values {stop}), norm as ("
            f"select distinct docname, language, token from (select docname, language, "
            f"unnest({_tokens('lower(cleaned_text)')}) as token from cleaned) where token not in (select word from stop))")


def _grams() -> str:
    letters = _sub("' ' || lower(cleaned_text) || ' '", r"[^\p{L}]+", " ")
    return (f"{CLEANED}, chars as (select docname, language, cleaned_text, regexp_extract_all({letters}, '.') as c "
            "from cleaned), grams as (select docname, language, unnest(list_transform(range(1, len(c) - 1), "
            "lambda i: c[i] || c[i + 1] || c[i + 2])) as gram from chars)")


def _profiles() -> str:
    return (f"{_grams()}, counts as (select language, gram, count(*) as n from grams group by all), "
            "totals as (select language, sum(n) as t from counts group by 1), "
            "vocab as (select distinct gram from counts), size as (select count(*) as v from vocab), "
            "profile as (select t.language, vocab.gram, cast(round(ln(cast(coalesce(n, 0) + 1 as double) / "
            "cast(t.t + v as double)) * 1000000.0::double) as bigint) as score, coalesce(n, 0) > 0 as seen from totals t cross join size "
            "cross join vocab left join counts c on c.language = t.language and c.gram = vocab.gram)")


def _detected() -> str:
    """Every trigram of these texts is in the profiles, which were fitted on them."""
    return (f"{_profiles()}, doc_counts as (select docname, gram, count(*) as n from grams group by all), "
            "scores as (select docname, p.language, sum(n * score) as s, sum(n) as total, "
            "sum(case when seen then n else 0 end) as known from doc_counts join profile p using (gram) "
            "group by all), detected as (select docname, case when known >= 0.6::double * total then language "
            "else 'unknown' end as detected_language from (select *, row_number() "
            "over (partition by docname order by s desc, language) as r from scores) where r = 1)")


def _hashed(fit: str = "true") -> str:
    """``marks`` (every trigram of every document with its places), ``kept`` counts and ``scored`` places of the fitted rows."""
    letters = _sub("' ' || lower(cleaned_text) || ' '", r"[^\p{L}]+", " ")
    where = "(unicode(c[i])::bigint * {} + unicode(c[i + 1])::bigint * {} + unicode(c[i + 2])::bigint * {}) % {} + {}".format
    places = {"p1": where(0, 0, 1, 16381, 0), "p2": where(0, 19349663, 83492791, 65521, 16381),
              "p3": where(73856093, 19349663, 83492791, 262139, 81902)}
    each = "{" + ", ".join(f"'{k}': {v}" for k, v in places.items()) + "}"
    return (f"{CLEANED}, chars as (select docname, language, regexp_extract_all({letters}, '.') as c from cleaned), "
            f"marks as (select docname, language, unnest(list_transform(range(1, len(c) - 1), lambda i: {each})) as m from chars), "
            f"fitted as (select language, unnest([m.p1, m.p2, m.p3]) as place from marks where {fit}), "
            "kept as (select language, place, count(*) as n from fitted group by all), "
            "lens as (select place, case when place < 16381 then 1 when place < 81902 then 2 else 3 end as len "
            "from (select distinct place from kept)), "
            "seen as (select len, count(*) as v from lens group by 1), "
            "sums as (select k.language, len, sum(n) as t from kept k join lens using (place) group by all), "
            "scored as (select s.language, l.place, coalesce(k.n, 0) as n, cast(round_even(ln((coalesce(k.n, 0) + 1)::double "
            "/ (s.t + v)::double) * 1000000.0::double * case l.len when 1 then 0.2::double when 2 then 0.4::double else 1.0::double "
            "end, 0) as bigint) as score from sums s join seen using (len) join lens l using (len) "
            "left join kept k on k.language = s.language and k.place = l.place)")


def _hashed_detected(rows: str = "true") -> str:
    return (f"used as (select docname, language, case when m.p3 in (select place from lens) then m.p3 "
            f"when m.p2 in (select place from lens) then m.p2 else m.p1 end as place, m.p3 as p3 from marks where {rows}), "
            "named as (select distinct language from kept), "
            "per_doc as (select u.docname, n.language, count(*) as total, sum(coalesce(s.score, 0)) as s, "
            "count(*) filter (coalesce(s3.n, 0) > 0) as known from used u cross join named n left join scored s "
            "on s.language = n.language and s.place = u.place left join scored s3 on s3.language = n.language and s3.place = u.p3 "
            "group by all), found as (select docname, case when known >= 0.6::double * total then language else 'unknown' end "
            "as detected_language from (select *, row_number() over (partition by docname order by s desc, language) as r "
            "from per_doc) where r = 1)")


def _languages() -> str:
    rows = [("en", ENGLISH_MODEL_NAME)] + [(c, MODEL_NAME.format(c)) for c in SUPPORTED_LANGUAGES]
    return f"languages(lang, model_name) as (values {_values(rows)})"


def _lexicon() -> str:
    rows = [(lang, t, es) for lang, words in TO_SPANISH.items() for t, es in words.items()]
    return f"lexicon(lang, token, es_token) as (values {_values(rows)})"


ROUTE = ("case when {l} = 'es' then 'identity' when {l} = 'en' then 'english' "
         "when model_name is not null then 'generic' else 'unsupported' end")


def _translated(language: str = "language", source: str = "cleaned") -> str:
    """``translated(docname, es_text)``: every word looked up in the lexicon of ``language``."""
    pieces = f"regexp_extract_all(cleaned_text, {_q(W + '+|[^' + W[1:-1] + ']+')})"
    return (f"{_lexicon()}, pieces as (select docname, {language} as l, unnest({pieces}) as piece, "
            f"generate_subscripts({pieces}, 1) as pos from {source}), "
            "translated as (select docname, string_agg(coalesce(es_token, piece), '' order by pos) as es_text "
            "from pieces left join lexicon on lang = l and token = lower(piece) group by docname)")


STORE = (", store as (select c.context, c.language, c.docname, coalesce(es_text, c.cleaned_text) as translated_text "
         "from cleaned c left join translated using (docname) "
         "where c.language in ('fr', 'en', 'es') and length(c.cleaned_text) > 0)")


def _store() -> str:
    return f"{CLEANED}, {_translated()}{STORE}"


def _rule_pos(t: str) -> str:
    cases = " ".join(f"when regexp_matches({t}, {_q(p)}) then {_q(pos)}" for p, pos in POS_RULES)
    return f"case {cases} else {_q(DEFAULT_POS)} end"


def _lemmas() -> str:
    """One row per kept token: ``lemma_rows(docname, token, lemma)``."""
    singular = ("case when regexp_matches(token, '(c|s)iones$') then regexp_replace(token, 'iones$', 'ión') "
                "when regexp_matches(token, 'ces$') then regexp_replace(token, 'ces$', 'z') "
                "when regexp_matches(token, '[bdfgjlmnñrtvxy]es$') then regexp_replace(token, 'es$', '') "
                "when regexp_matches(token, '[aeioué]s$') then regexp_replace(token, 's$', '') else token end")
    return (f"{_normalized()}, forms(form, form_lemma, form_pos) as (values {_values(SPANISH_FORMS)}), "
            "vocab as (select distinct token from norm), "
            f"ruled as (select token, {_rule_pos('token')} as rule_pos, {singular} as singular from vocab), "
            "tagged as (select token, coalesce(form_pos, rule_pos) as pos, coalesce(form_lemma, case "
            "when coalesce(form_pos, rule_pos) = 'ADJ' and regexp_matches(token, '(os|iv|ic|ad|id)as?$') "
            "then regexp_replace(singular, 'a$', 'o') else singular end) as lemma "
            "from ruled left join forms on form = token), "
            "lemma_rows as (select docname, token, lemma from norm join tagged using (token) "
            "where pos in ('NOUN', 'ADJ'))")


def _last(word: str, alternatives: str) -> str:
    return f"regexp_extract({word}, {_q('(' + alternatives + ')$')}, 1)"


def _stems() -> str:
    """``stems(lemma, stem)`` for every distinct lemma, one published step per CTE."""
    v, c = f"[{st.VOWEL}]", f"[^{st.VOWEL}]"

    def prefix(pattern):
        found = f"length(regexp_extract(lemma, {_q(pattern)}))"
        return f"case when {found} > 0 then {found} else length(lemma) end"

    def more(base, endings):
        ending = _last(base, endings)
        return (f"(case when {ending} <> '' and length({base}) - length({ending}) >= r2 "
                f"then left({base}, length({base}) - length({ending})) else {base} end)")

    def one_of(alternatives):
        return "suffix in (" + ", ".join(_q(a) for a in alternatives.split("|")) + ")"

    all_standard = "|".join([st.STANDARD_DELETE, st.STANDARD_ATION, st.STANDARD_LOGY, st.STANDARD_UTION,
                             st.STANDARD_ENCY, st.STANDARD_AMENTE, st.STANDARD_ADVERB, st.STANDARD_ITY,
                             st.STANDARD_IVE])
    steps = [
        ("s0", f"select lemma, lemma as w, {prefix(f'^{c}*{v}+{c}')} as r1, {prefix(f'^{c}*{v}+{c}{c}*{v}+{c}')} as r2, "
               f"case when regexp_matches(lemma, {_q('^.' + c)}) then {prefix('^.' + c + c + '*' + v)} "
               f"when regexp_matches(lemma, {_q('^' + v + v)}) then {prefix('^' + v + v + v + '*' + c)} "
               "else least(3, length(lemma)) end as rv from (select distinct lemma from lemma_rows)"),
        ("s1a", f"select *, {_last('w', st.PRONOUNS)} as p from s0"),
        ("s1b", "select *, left(w, length(w) - length(p)) as b from s1a"),
        ("s1c", f"select *, {_last('b', st.GERUND_OR_INFINITIVE_ACCENTED)} as acc, "
                f"{_last('b', st.GERUND_OR_INFINITIVE)} as pl from s1b"),
        ("s1", "select lemma, r1, r2, rv, case when p = '' then w when acc <> '' and length(b) - length(acc) >= rv "
               "then left(b, length(b) - length(acc)) || translate(acc, 'áéí', 'aei') "
               "when pl <> '' and length(b) - length(pl) >= rv then b "
               "when regexp_matches(b, 'uyendo$') and length(b) - 5 >= rv then b else w end as w from s1c"),
        ("s2a", f"select *, {_last('w', all_standard)} as suffix from s1"),
        ("s2b", "select *, left(w, length(w) - length(suffix)) as b from s2a"),
        ("s2", "select lemma, rv, w as before, case "
               f"when suffix = '' then w when suffix = 'amente' then case when length(b) < r1 then w "
               f"when regexp_matches(b, 'iv$') and length(b) - 2 >= r2 then {more('left(b, length(b) - 2)', 'at')} "
               f"else {more('b', 'os|ic|ad')} end when length(b) < r2 then w "
               f"when {one_of(st.STANDARD_ATION)} then {more('b', 'ic')} when {one_of(st.STANDARD_LOGY)} then b || 'log' "
               f"when {one_of(st.STANDARD_UTION)} then b || 'u' when {one_of(st.STANDARD_ENCY)} then b || 'ente' "
               f"when suffix = 'mente' then {more('b', 'ante|able|ible')} "
               f"when {one_of(st.STANDARD_ITY)} then {more('b', 'abil|ic|iv')} "
               f"when {one_of(st.STANDARD_IVE)} then {more('b', 'at')} else b end as w from s2b"),
        ("s3a", f"select *, {_last('w', st.Y_VERB)} as y, "
                f"{_last('substring(w, rv + 1)', st.VERB + '|' + st.VERB_AFTER_GU)} as suffix from s2"),
        ("s3", "select lemma, rv, case when w <> before then w "
               "when y <> '' and length(w) - length(y) >= rv and regexp_matches(left(w, length(w) - length(y)), 'u$') "
               "then left(w, length(w) - length(y)) when suffix = '' then w "
               "when suffix in ('en', 'es', 'éis', 'emos') and regexp_matches(left(w, length(w) - length(suffix)), 'gu$') "
               "then left(w, length(w) - length(suffix) - 1) else left(w, length(w) - length(suffix)) end as w from s3a"),
        ("s4a", f"select *, {_last('substring(w, rv + 1)', st.RESIDUAL)} as r, "
                f"{_last('substring(w, rv + 1)', st.RESIDUAL_E)} as e from s3"),
        ("stems", "select lemma, translate(case when r <> '' then left(w, length(w) - length(r)) "
                  "when e <> '' and regexp_matches(left(w, length(w) - 1), 'gu$') and length(w) - 2 >= rv "
                  "then left(w, length(w) - 2) when e <> '' then left(w, length(w) - 1) else w end, "
                  "'áéíóú', 'aeiou') as stem from s4a"),
    ]
    return _lemmas() + "".join(f", {name} as ({body})" for name, body in steps)


def _word_vectors() -> str:
    return (f"{_normalized()}, df as (select token as word, count(*) as n from norm group by 1), "
            "ranked as (select word, row_number() over (order by n desc, word) - 1 as vec_id from df), "
            "wv as (select word, embedding from ranked join embeddings using (vec_id))")


def _list(order: str, value: str) -> str:
    return f"coalesce(string_agg({value}, ' ' order by {order}), '')"


def _key_hash(key: str) -> str:
    return f"md5('{SEED}|' || {key})"


def _report(pairs: str) -> str:
    """``pairs`` is a query with varchar columns ``y`` and ``p``."""
    return (f"with pairs as ({pairs}), labels as (select y as label from pairs union select p from pairs "
            "where p is not null), c as (select label, (select count(*) from pairs where y = label) as support, "
            "(select count(*) from pairs where p = label) as guessed, "
            "(select count(*) from pairs where y = label and p = label) as hits from labels), "
            "m as (select *, coalesce(hits::double / nullif(guessed, 0), 0) as pr, "
            "coalesce(hits::double / nullif(support, 0), 0) as rc from c), "
            "f as (select *, coalesce(2 * pr * rc / nullif(pr + rc, 0), 0) as f1_ from m) "
            "select label, round(pr, 6) as precision, round(rc, 6) as recall, round(f1_, 6) as f1, support from f "
            "union all select 'accuracy', round(sum(hits)::double / sum(support), 6), "
            "round(sum(hits)::double / sum(support), 6), round(sum(hits)::double / sum(support), 6), "
            "cast(sum(support) as bigint) from f "
            "union all select 'macro avg', round(avg(pr), 6), round(avg(rc), 6), round(avg(f1_), 6), "
            "cast(sum(support) as bigint) from f "
            "union all select 'weighted avg', round(sum(pr * support) / sum(support), 6), "
            "round(sum(rc * support) / sum(support), 6), round(sum(f1_ * support) / sum(support), 6), "
            "cast(sum(support) as bigint) from f")


def _builders() -> dict[str, Callable[[], str]]:
    """Each SQL text as a function, so that one that cannot be made costs one query."""
    normalized_words = f"select token as word, count(*) as n from norm group by 1"
    kept_docs = ("select c.docname, {agg} as {name} from cleaned c left join {rows} r using (docname) group by 1")
    weights = (", w as (select language as topic, token as word, cast(count(*) as double) as weight from norm "
               "group by all)")
    # The white-space and trailer patterns below.
    strip = r"regexp_replace(text, '^\s+|\s+$', '', 'g')"
    return {
        "corpus_scan": lambda: _with(CORPUS, f"select context, language, docname, {strip} as text from corpus"),
        "word_vectors_scan": lambda: _with(
            _word_vectors(), "select word, len(embedding) as dims, "
            "round(list_sum(list_transform(embedding, lambda x: x::double)), 6) as total from wv"),
        "translation_store_write": lambda: _with(_store(), "select * from store"),
        "translation_lookup": lambda: _with(_store(), "select c.docname, translated_text from corpus c left join store "
                                    "using (context, language, docname)"),
        "translated_only": lambda: _with(_store(), "select docname, language from store"),
        "sample_n": lambda: _with(CORPUS, f"select docname, language from corpus order by {_key_hash('docname')}, docname "
                          "limit 10"),
        "peek": lambda: _with(CORPUS, "select * from corpus order by docname limit 5"),
        "peek_row": lambda: _with(CORPUS, "select * from corpus order by docname limit 1 offset 100"),
        "clean_pixels": lambda: _with(CORPUS, "select docname, " + _pixels("length(text) || 'px|' || text || ' 12px'")
                              + " as cleaned_text from corpus"),
        "clean_box_assign": lambda: f"select page_id, {_box('html')} as cleaned_text from pages",
        "remove_long_words": lambda: _with(CORPUS, f"select docname, {_long('text')} as cleaned_text from corpus"),
        "remove_urls": lambda: "select page_id, " + _urls("'see ' || url || ' for more. ' || html")
                       + " as cleaned_text from pages",
        "clean_text": lambda: _with(CLEANED, "select docname, cleaned_text from cleaned"),
        "strip_wiki_trailers": lambda: _with(
            CORPUS, "select docname, " + _sub(_sub(
                "text || chr(10) || 'Category: ' || context || chr(10) || '* ' || language || ': ' || docname "
                "|| chr(10) || 'end'", r"(?m)(Categoría|Catégorie|Category):.+$"), r"(?m)\*\s[a-z]+:.*$")
            + " as stripped_text from corpus"),
        "nonempty_cleaned": lambda: _with(CLEANED, "select docname from cleaned where length(cleaned_text) > 0"),
        "fit_language_profiles": lambda: _with(_profiles(), "select language, gram, score from profile"),
        "detect_language": lambda: _with(_detected(), "select docname, detected_language from cleaned left join detected "
                                 "using (docname)"),
        "safe_detect": lambda: _with(_detected(), "select docname, detected_language from cleaned left join detected "
                             "using (docname) union all select 'n' || docname, null from cleaned"),
        "language_mismatch_counts": lambda: _with(
            _detected(), "select c.language is distinct from detected_language as mismatch, count(*) as n "
            "from cleaned c left join detected using (docname) group by 1"),
        "supported_languages": lambda: _with(_languages(), "select l.lang, model_name, count(d.lang) as n from languages l "
                                     "left join documents d on d.lang = l.lang group by all"),
        "route_translation": lambda: _with(
            f"{CORPUS}, {_languages()}", f"select docname, language, {ROUTE.format(l='language')} as route, "
            "model_name from corpus left join languages on lang = language"),
        "english_target_prefix": lambda: _with(
            CLEANED, f"select docname, case when language = 'en' then {_q(ENGLISH_TARGET_PREFIX)} else '' end "
            "|| cleaned_text as model_input from cleaned"),
        "translation_batches": lambda: _with(
            f"{CLEANED}, b as (select docname, language, cast(floor((row_number() over (partition by language "
            f"order by {_key_hash('docname')}, docname) - 1) / 15) as bigint) as batch from cleaned "
            "where length(cleaned_text) > 0)",
            "select docname, language, batch, count(*) over (partition by language, batch) as batch_rows, "
            "count(*) over (partition by language, batch) < 15 as is_short from b"),
        "translate_batch": lambda: _with(f"{CLEANED}, {_translated()}", "select c.docname, coalesce(es_text, cleaned_text) "
                                 "as translated_text from cleaned c left join translated using (docname)"),
        "translate_with_model": lambda: _with(
            f"{CLEANED}, {_translated()}", "select c.docname, coalesce(es_text, cleaned_text) "
            "as translated_text from cleaned c left join translated using (docname)"),
        "translate_corpus": lambda: _with(_store(), "select * from store"),
        "translate_detected": lambda: _with(
            f"{_detected()}, {_languages()}, routed as (select docname, cleaned_text, detected_language, "
            f"{ROUTE.format(l='detected_language')} as route from cleaned left join detected using (docname) "
            f"left join languages on lang = detected_language), {_translated('detected_language', 'routed')}",
            "select docname, detected_language, route, case route when 'identity' then cleaned_text "
            "when 'unsupported' then null else coalesce(es_text, cleaned_text) end as translated_text "
            "from routed left join translated using (docname)"),
        "tokenize": lambda: _with(CORPUS, f"select docname, array_to_string({_tokens('text')}, ' ') as tokens from corpus"),
        "lowercase_tokens": lambda: _with(
            CORPUS, f"select docname, array_to_string(list_transform({_tokens('text')}, lambda t: lower(t)), ' ') "
            "as tokens from corpus"),
        "dedupe_tokens": lambda: _with(
            f"{CORPUS}, t as (select distinct docname, unnest({_tokens('lower(text)')}) as token from corpus)",
            f"select docname, {_list('token', 'token')} as tokens from corpus left join t using (docname) group by 1"),
        "remove_stopwords": lambda: _with(
            f"{CORPUS}, stop(word) as (values {', '.join(f'({_q(w)})' for w in spanish_stopwords())}), "
            f"t as (select docname, unnest({_tokens('text')}) as token, generate_subscripts({_tokens('text')}, 1) "
            "as pos from corpus), kept as (select * from t where lower(token) not in (select word from stop))",
            f"select docname, {_list('pos', 'token')} as tokens from corpus left join kept using (docname) group by 1"),
        "keep_in_vocabulary": lambda: _with(
            f"{_word_vectors()}, kept as (select docname, token from norm join wv on word = token)",
            kept_docs.format(agg=_list("token", "token"), name="normalized_text", rows="kept")),
        "normalize_document": lambda: _with(_normalized(), kept_docs.format(agg=_list("token", "token"),
                                                                    name="normalized_text", rows="norm")),
        "nonempty_normalized": lambda: _with(_normalized(), "select distinct docname from norm"),
        "lemmatize_pos_filter": lambda: _with(_lemmas(), kept_docs.format(agg=_list("token", "lemma"),
                                                                  name="lemmatized_text", rows="lemma_rows")),
        "nonempty_lemmas": lambda: _with(_lemmas(), "select distinct docname from lemma_rows"),
        "stem_vocabulary": lambda: _with(
            f"{_stems()}, stem_rows as (select docname, token, stem from lemma_rows join stems using (lemma))",
            kept_docs.format(agg=_list("token", "stem"), name="stemmed_text", rows="stem_rows")),
        "words_in_model": lambda: _with(
            f"{_word_vectors()}, known as (select docname, token from norm join wv on word = token)",
            "select c.docname, count(token) as known_words from cleaned c left join known using (docname) group by 1"),
        "document_to_vector": lambda: _with(
            f"{_word_vectors()}, cells as (select docname, unnest(range(len(embedding))) as dim, "
            "unnest(embedding)::double as x from norm join wv on word = token)",
            "select docname, dim, round(avg(x), 6) as value from cells group by all"),
        "drop_unembeddable": lambda: _with(
            f"{_word_vectors()}, known as (select distinct docname from norm join wv on word = token)",
            "select k.docname is not null as embedded, count(*) as n from cleaned c left join known k "
            "on k.docname = c.docname group by 1"),
        "vector_to_matrix": lambda: "select vec_id, len(embedding) as dims, round(list_sum(list_transform(embedding, "
                            "lambda x: x::double)), 6) as total from embeddings",
        "encode_classes": lambda: _with(CORPUS, "select docname, context, dense_rank() over (order by context) - 1 "
                                "as context_categorical from corpus"),
        "holdout_split": lambda: _with(
            CORPUS, f"select docname, row_number() over (order by {_key_hash('docname')}, docname) <= "
            "ceil(count(*) over () * 0.1::double) as is_test from corpus"),
        "classification_report": lambda: _report(
            "select cast(quality as varchar) as y, cast(cast(n_chars > 1000 as int) as varchar) as p "
            "from labels join documents using (doc_id)"),
        "classification_report_language": lambda: _report(
            _with(_detected(), "select c.language as y, detected_language as p from cleaned c left join detected "
                  "using (docname)")),
        "nearest_words": lambda: _with(
            f"{_word_vectors()}, cells as (select label, unnest(range(len(embedding))) as dim, "
            "unnest(embedding)::double as x from embeddings), centers as (select label, dim, avg(x) as c from cells "
            "group by all), wcells as (select word, unnest(range(len(embedding))) as dim, unnest(embedding)::double "
            "as x from wv), sims as (select label as topic, word, round(sum(x * c) / (sqrt(sum(x * x)) * "
            "sqrt(sum(c * c))), 6) as similarity from wcells join centers using (dim) group by all), "
            "r as (select *, row_number() over (partition by topic order by similarity desc, word) as rank from sims)",
            "select cast(topic as bigint) as topic, rank, word, similarity from r where rank <= 50"),
        "build_dictionary": lambda: _with(
            f"{_lemmas()}, d as (select lemma as token, count(distinct docname) as doc_freq from lemma_rows group by 1)",
            f"select token, row_number() over (order by {_key_hash('token')}, token) - 1 as token_id, doc_freq from d"),
        "filter_extremes": lambda: _with(
            f"{_lemmas()}, d as (select lemma as token, count(distinct docname) as doc_freq from lemma_rows group by 1)",
            "select token, doc_freq from d where doc_freq >= 50 and doc_freq <= 0.5 * "
            "(select count(distinct docname) from lemma_rows)"),
        "bag_of_words": lambda: _with(_lemmas(), "select docname, lemma as token, count(*) as n from lemma_rows group by all"),
        "corpus_stats": lambda: _with(
            _lemmas(), "select 'unique_tokens' as stat, count(distinct lemma) as value from lemma_rows "
            "union all select 'documents', count(distinct docname) from lemma_rows"),
        "isotonic_calibration": lambda: _with(
            "scored as (select quality, n_chars / (n_chars + 1000)::double as score from labels join documents using (doc_id)), "
            "c as (select least(floor(score * 64), 63)::bigint as bin, count(*) as n, count(*) filter (quality = 1) as positives "
            "from scored where score is not null group by 1), "
            "means as (select s.bin as s, e.bin as e, sum(i.positives) / sum(i.n) as mean from c s join c e on s.bin <= e.bin "
            "join c i on i.bin between s.bin and e.bin group by all), "
            "least_means as (select bin, s, min(mean) as least from c join means on bin between s and e group by all)",
            "select bin, n, positives, round(max(least), 6) as rate from c join least_means using (bin) group by all"),
        "tagger_counts": lambda: _with(
            f"{CLEANED}, parts as (select docname, unnest(string_split_regex(lower(cleaned_text), "
            f"{_q('[.!?…]+[ ' + chr(9) + chr(13) + chr(10) + ']+|' + chr(10) + '+')})) as part from cleaned), "
            f"sents as (select row_number() over () as s, {_tokens('part')} as tokens from parts), "
            "words as (select s, unnest(tokens) as token, generate_subscripts(tokens, 1) as pos from sents), "
            f"forms(form, lemma, form_pos) as (values {_values(SPANISH_FORMS)}), "
            "classes as (select form, min(form_pos) as form_pos, count(distinct form_pos) as several from forms group by 1), "
            f"vocab as (select token, case when several > 1 then '' else coalesce(form_pos, {_rule_pos('token')}) end as tag "
            "from (select distinct token from words) left join classes on form = token), "
            "tagged as (select s, pos, token, tag from words join vocab using (token)), "
            "steps as (select coalesce(lag(tag) over w, '^') as a, tag as b from tagged window w as (partition by s order by pos) "
            "union all select arg_max(tag, pos), '$' from tagged group by s)",
            "select 'follow' as kind, a, b, count(*) as n from steps where a <> '' and b <> '' group by all "
            "union all select 'word', tag, token, count(*) from tagged where tag <> '' group by all"),
        "fit_hashed_profiles": lambda: _with(_hashed(), "select language, place, n from kept"),
        "detect_language_hashed": lambda: _with(
            f"{_hashed()}, {_hashed_detected()}", "select docname, detected_language from cleaned left join found using (docname)"),
        "language_accuracy_by_length": lambda: _with(
            f"{_hashed('docname::bigint % 10 <> 0')}, {_hashed_detected('docname::bigint % 10 = 0')}, "
            "sized as (select docname, language, len(c) as size from chars where docname::bigint % 10 = 0)",
            "select case when size >= 3000 then 3000 when size >= 1000 then 1000 when size >= 300 then 300 "
            "when size >= 100 then 100 else 0 end as least, count(*) as n, "
            "count(*) filter (detected_language = language) as correct, "
            "count(*) filter (detected_language = 'unknown') as unknown from sized left join found using (docname) group by 1"),
        "translate_phrases": lambda: "with recursive " + (
            f"{CLEANED}, items as (select item_id % 4 + 1 as n, regexp_extract_all(lower(text), {_q(W + '+')}) as w from benchmark), "
            "lex as (select distinct n, array_to_string(w[1:n], ' ') as phrase from items where len(w) >= n), "
            f"cut as (select docname, language, regexp_extract_all(cleaned_text, {_q(W + '+|[^' + W[1:-1] + ']+')}) as p from cleaned), "
            "places as (select docname, unnest(range(1, len(p) + 1)) as i, p from cut where language = 'en'), "
            "tried as (select docname, i, n, lower(array_to_string(list_filter(p[i:i + 2 * n - 2], lambda x, k: k % 2 = 1), ' ')) "
            "as phrase from places, range(1, 5) r(n) where i + 2 * n - 2 <= len(p) and len(list_filter(p[i:i + 2 * n - 2], "
            f"lambda x, k: k % 2 = 0 and regexp_matches(x, '[^' || {_q(chr(92) + 's')} || ']'))) = 0), "
            "hits as (select docname, i, max(n) as n, arg_max(phrase, n) as phrase from tried join lex using (n, phrase) group by all), "
            "chosen as (select docname, min(i) as i, arg_min(n, i) as n, arg_min(phrase, i) as phrase from hits group by 1 "
            "union all select c.docname, h.i, h.n, h.phrase from chosen c join hits h on h.docname = c.docname "
            "and h.i >= c.i + 2 * c.n - 1 qualify row_number() over (partition by c.docname order by h.i) = 1), "
            "made as (select p.docname, string_agg(case when p.i = c.i then '<' || upper(c.phrase) || '>' "
            "when p.i <= c.i + 2 * c.n - 2 then '' else p.p[p.i] end, '' order by p.i) as es "
            "from places p asof left join chosen c on c.docname = p.docname and p.i >= c.i group by 1) "
            "select docname, coalesce(es, cleaned_text) as translated_text from cleaned left join made using (docname)"),
        "topic_word_weights": lambda: _with(
            f"{_normalized()}{weights}, r as (select *, row_number() over (partition by topic order by weight desc, "
            "word) as rank, max(weight) over (partition by topic) as top from w)",
            "select topic, rank, word, weight, round(weight / top, 6) as relative from r where rank <= 10"),
        "topic_term_relevance": lambda: _with(
            f"{_normalized()}{weights}, p as (select topic, word, weight / sum(weight) over (partition by topic) as pwt, "
            "sum(weight) over (partition by word) / sum(weight) over () as pw from w), "
            "s as (select topic, word, round(0.6::double * ln(pwt) + (1 - 0.6::double) * ln(pwt / pw), 6) as relevance "
            "from p), r as (select *, row_number() over (partition by topic order by relevance desc, word) as rank "
            "from s)", "select topic, rank, word, relevance from r where rank <= 30"),
        "topic_distances": lambda: _with(
            f"{_normalized()}{weights}, p as (select topic, word, weight / sum(weight) over (partition by topic) as p from w "
            "where topic is not null), s as (select a.topic, b.topic as other, sum(a.p) + sum(b.p) as mass, "
            "sum(a.p * ln(2 * a.p / (a.p + b.p)) + b.p * ln(2 * b.p / (a.p + b.p))) as part "
            "from p a join p b on a.word = b.word and a.topic < b.topic group by 1, 2), t as (select distinct topic from p)",
            "select x.topic, y.topic as other, round((coalesce(part, 0) + ln(2) * (2 - coalesce(mass, 0))) / 2, 6) as divergence "
            "from t x join t y on x.topic < y.topic left join s on s.topic = x.topic and s.other = y.topic"),
        "count_documents": lambda: "select count(*) as n from documents",
        "docs_by_language": lambda: _with(CORPUS, "select language, count(*) as n from corpus group by 1 order by 2 desc, 1"),
        "docs_by_context": lambda: _with(CORPUS, "select context, count(*) as n from corpus group by 1 order by 2 desc, 1"),
        "docs_by_docname": lambda: _with(CORPUS, "select docname, count(*) as n from corpus group by 1 order by 2 desc, 1"),
        "missing_translation_counts": lambda: _with(
            _store(), "select translated_text is null as missing, count(*) as n from corpus left join store "
            "using (context, language, docname) group by 1"),
        "word_frequencies": lambda: _with(_normalized(), normalized_words),
        "word_frequencies_top": lambda: _with(_normalized(), normalized_words + " order by n desc, word limit 200"),
    }


def oracle_sql() -> dict[str, str]:
    made = {}
    for name, build in _builders().items():
        try:
            made[name] = build()
        except Exception as e:
            print(f"no SQL for {name}: {e!r}", file=sys.stderr)
    return made
