"""DuckDB SQL that gives the same results as the registered queries, for checking only."""

from __future__ import annotations

# Fixed values, written out here again so that a wrong constant of the package shows.
STOPWORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her
hers herself it its itself they them their theirs themselves what which who whom this that these
those am is are was were be been being have has had having do does did doing a an the and but if or
because as until while of at by for with about against between into through during before after above
below to from up down in out on off over under again further then once here there when where why how
all any both each few more most other some such no nor not only own same so than too very s t can
will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd
i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't weren't
haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't
cannot could here's how's let's ought that's there's what's when's where's who's why's would
""".split()
TOKEN_PATTERN = "[a-zA-Z]+(?:[-'][a-zA-Z]+)?"
CUTOFF_YEAR = 1997
NOUN_RULES = (
    ("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"), ("ches", "ch"), ("shes", "sh"),
    ("men", "man"), ("ies", "y"),
)
SCOPES = ("Body only", "Body + Title", "Body + Title + Metadata")
REPRESENTATIONS = ("Count", "Mean vector", "TF-IDF weighted vector")
MODELS = ("Logistic Regression", "Decision Tree", "Random Forest")
METRICS = ("accuracy", "macro_precision", "macro_recall", "macro_f1", "roc_auc")
# Suffix rules of the Porter stemmer as the usual Python version has them.
STEM_2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
    ("fulli", "ful"),
)
STEM_3 = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""),
    ("ness", ""),
)
STEM_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou",
    "ism", "ate", "iti", "ous", "ive", "ize",
)
STEM_EXCEPTIONS = (
    ("sky", "sky"), ("skies", "sky"), ("dying", "die"), ("lying", "lie"), ("tying", "tie"),
    ("news", "news"), ("innings", "inning"), ("inning", "inning"), ("outings", "outing"),
    ("outing", "outing"), ("cannings", "canning"), ("canning", "canning"), ("howe", "howe"),
    ("proceed", "proceed"), ("exceed", "exceed"), ("succeed", "succeed"),
)


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _rows(*rows) -> str:
    return ", ".join(
        "(" + ", ".join(_quoted(v) if isinstance(v, str) else str(v) for v in row) + ")"
        for row in rows
    )


PATTERN = _quoted(TOKEN_PATTERN)

# Named subqueries; a query lists the ones it needs in order.
CTES = {
    "reviews": """
        SELECT d.doc_id, CAST(d.doc_id AS VARCHAR) AS review_id,
               CAST(k.product AS VARCHAR) AS product_id,
               regexp_extract(d.text, '^[^.\\n]*', 0) AS review_title, d.text AS review_text,
               CAST(1 + d.n_chars % 5 AS DOUBLE) AS review_rating,
               strftime(o.o_orderdate, '%d-%m-%Y') AS review_date, CAST(NULL AS VARCHAR) AS author,
               l.quality = 1 AS is_a_buyer, p.p_retailprice AS price,
               r.avg_product_rating, r.product_rating_count, d.source AS brand_name,
               p.p_name || ' ' || b.text AS product_title, CAST(NULL AS VARCHAR) AS product_url,
               CAST(NULL AS VARCHAR) AS product_tags
        FROM documents d
        LEFT JOIN orders o ON o.o_orderkey = d.doc_id
        LEFT JOIN labels l ON l.doc_id = d.doc_id
        LEFT JOIN (SELECT l_orderkey, min(l_partkey) AS product FROM lineitem GROUP BY 1) k
               ON k.l_orderkey = d.doc_id
        LEFT JOIN part p ON p.p_partkey = k.product
        LEFT JOIN benchmark b ON b.item_id = k.product % (SELECT count(*) FROM benchmark)
        LEFT JOIN (SELECT l_partkey, avg(l_quantity) AS avg_product_rating,
                          count(*) AS product_rating_count
                   FROM lineitem GROUP BY l_partkey) r ON r.l_partkey = k.product""",
    "stop": f"SELECT * FROM (VALUES {_rows(*[(w,) for w in STOPWORDS])}) AS s(word)",
}


def _tokens(name: str, column: str) -> None:
    """CTEs ``<name>_raw`` (all tokens) and ``<name>_clean`` (long enough, no stop words)."""
    CTES[f"{name}_raw"] = f"""
        SELECT doc_id, lower(unnest(l)) AS term, unnest(range(len(l))) AS pos
        FROM (SELECT doc_id, regexp_extract_all(coalesce({column}, ''), {PATTERN}) AS l
              FROM reviews)"""
    CTES[f"{name}_clean"] = f"""
        SELECT * FROM {name}_raw
        WHERE length(term) >= 2 AND term NOT IN (SELECT word FROM stop)"""


for _name, _column in (("body", "review_text"), ("title", "review_title"), ("ptitle", "product_title")):
    _tokens(_name, _column)

CTES |= {
    "freq": """
        SELECT term, count(*) AS cnt, count(DISTINCT doc_id) AS df FROM body_clean GROUP BY term""",
    "body_common": "SELECT b.* FROM body_clean b JOIN freq f ON f.term = b.term AND f.cnt > 1",
    "top": "SELECT term, df FROM freq WHERE cnt > 1 ORDER BY df DESC, term LIMIT 20",
    "body_final": "SELECT * FROM body_common WHERE term NOT IN (SELECT term FROM top)",
    "all_terms": """
        SELECT DISTINCT term FROM body_final UNION SELECT term FROM title_clean
        UNION SELECT term FROM ptitle_clean""",
    "lexicon": "SELECT term AS word FROM freq WHERE cnt > 1",
    "forms": """
        SELECT l.term, s.stem AS form FROM lemmas l JOIN form_stems s ON s.word = l.lemma""",
    "vocab": """
        SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx
        FROM (SELECT DISTINCT term FROM body_forms)""",
    "embedded": """
        SELECT v.term, e.embedding AS vector
        FROM vocab v JOIN embeddings e ON e.vec_id = v.idx % (SELECT count(*) FROM embeddings)""",
}
for _name, _column in (("body", "body_final"), ("title", "title_clean"), ("ptitle", "ptitle_clean")):
    CTES[f"{_name}_forms"] = f"""
        SELECT t.doc_id, f.form AS term, t.pos FROM {_column} t JOIN forms f ON f.term = t.term"""


def _lemmas(terms: str, lexicon: str) -> str:
    """``(term, lemma)``: noun rules over a table of terms, given a table of known words."""
    return f"""
        SELECT f.term, coalesce(m.lemma, f.term) AS lemma
        FROM {terms} f LEFT JOIN (
            SELECT c.term, arg_min(c.word, (length(c.word), c.word)) AS lemma
            FROM (SELECT t.term, left(t.term, length(t.term) - t.n) || r.replacement AS word
                  FROM (SELECT term, unnest([1, 2, 3, 4]) AS n FROM {terms}) t
                  JOIN (VALUES {_rows(*NOUN_RULES)}) AS r(suffix, replacement)
                       ON right(t.term, t.n) = r.suffix AND t.n = length(r.suffix)
                  UNION ALL SELECT term, term FROM {terms}) c
            JOIN {lexicon} l ON l.word = c.word
            GROUP BY c.term) m ON m.term = f.term"""


CTES["lemmas"] = _lemmas("all_terms", "lexicon")


def _stems(name: str, source: str, column: str) -> list[str]:
    """CTEs that stem the distinct words of a column, step by step; the last is ``<name>_stems``.

    ``w`` is the word so far and ``s`` its letters as V and C, a y being V after C.
    """
    shape = "regexp_replace(regexp_replace(w, '[^aeiouy]', 'C', 'g'), '[aeiou]', 'V', 'g')"
    for _ in range(4):
        shape = f"regexp_replace(regexp_replace({shape}, 'Cy', 'CV', 'g'), '(^|V)y', '\\1C', 'g')"

    def w(cut):
        return f"left(w, length(w) - {cut})"

    def s(cut):
        return f"left(s, length(w) - {cut})"

    def m(cut):
        return f"len(regexp_extract_all({s(cut)}, 'V+C+'))"

    def short(cut):
        return f"({s(cut)} = 'VC' OR (right({s(cut)}, 3) = 'CVC' AND right({w(cut)}, 1) NOT IN ('w', 'x', 'y')))"

    def ed_ing(cut):
        return f"""CASE WHEN NOT contains({s(cut)}, 'V') THEN w
            WHEN regexp_matches({w(cut)}, '(at|bl|iz)$') THEN {w(cut)} || 'e'
            WHEN regexp_matches({w(cut)}, '(.)$') AND length(w) > {cut + 1}
                 AND right({w(cut)}, 1) = right({w(cut + 1)}, 1) AND right({s(cut)}, 1) = 'C'
                 AND right({w(cut)}, 1) NOT IN ('l', 's', 'z') THEN {w(cut + 1)}
            WHEN {m(cut)} = 1 AND {short(cut)} THEN {w(cut)} || 'e' ELSE {w(cut)} END"""

    def mapped(rules):
        cases = " ".join(
            f"WHEN ends_with(w, '{a}') THEN CASE WHEN {m(len(a))} > 0 THEN {w(len(a))} || '{b}' ELSE w END"
            for a, b in sorted(rules, key=lambda rule: -len(rule[0]))
        )
        return f"CASE {cases} ELSE w END"

    stripped = " ".join(
        f"WHEN ends_with(w, '{a}') THEN CASE WHEN {m(len(a))} > 1"
        + (f" AND right({w(3)}, 1) IN ('s', 't')" if a == "ion" else "")
        + f" THEN {w(len(a))} ELSE w END"
        for a in sorted(STEM_4, key=lambda a: -len(a))
    )
    steps = [
        f"""CASE WHEN ends_with(w, 'sses') THEN {w(2)}
            WHEN ends_with(w, 'ies') THEN CASE WHEN length(w) = 4 THEN {w(1)} ELSE {w(2)} END
            WHEN ends_with(w, 's') AND NOT ends_with(w, 'ss') THEN {w(1)} ELSE w END""",
        f"""CASE WHEN ends_with(w, 'ied') THEN CASE WHEN length(w) = 4 THEN {w(1)} ELSE {w(2)} END
            WHEN ends_with(w, 'eed') THEN CASE WHEN {m(3)} > 0 THEN {w(1)} ELSE w END
            WHEN ends_with(w, 'ed') THEN {ed_ing(2)} WHEN ends_with(w, 'ing') THEN {ed_ing(3)}
            ELSE w END""",
        f"""CASE WHEN ends_with(w, 'y') AND length(w) > 2 AND right({s(1)}, 1) = 'C'
            THEN {w(1)} || 'i' ELSE w END""",
        f"CASE WHEN ends_with(w, 'alli') AND {m(4)} > 0 THEN {w(2)} ELSE w END",
        f"""CASE WHEN ends_with(w, 'logi') THEN CASE WHEN {m(3)} > 0 THEN {w(1)} ELSE w END
            ELSE {mapped(STEM_2)} END""",
        mapped(STEM_3),
        f"CASE {stripped} ELSE w END",
        f"""CASE WHEN ends_with(w, 'e') AND ({m(1)} > 1 OR ({m(1)} = 1 AND NOT {short(1)}))
            THEN {w(1)} ELSE w END""",
        f"CASE WHEN ends_with(w, 'll') AND {m(1)} > 1 THEN {w(1)} ELSE w END",
    ]
    names = [f"{name}_step0"]
    CTES[names[0]] = f"SELECT DISTINCT {column} AS word, {column} AS w FROM {source}"
    for i, step in enumerate(steps):
        names.append(f"{name}_step{i + 1}")
        CTES[names[-1]] = f"SELECT word, {step} AS w FROM (SELECT *, {shape} AS s FROM {names[-2]})"
    CTES[f"{name}_stems"] = f"""
        SELECT word, coalesce(e.stem, CASE WHEN length(word) <= 2 THEN word ELSE w END) AS stem
        FROM {names[-1]} LEFT JOIN (VALUES {_rows(*STEM_EXCEPTIONS)}) AS e(known, stem) ON e.known = word"""
    return [*names, f"{name}_stems"]


_FORM_STEMS = _stems("form", "lemmas", "lemma")
_TERM_STEMS = _stems("term", "freq", "term")
TEXT = ["reviews", "stop", "body_raw", "body_clean"]
FINAL = [*TEXT, "freq", "body_common", "top", "body_final"]
FORMED = [
    *FINAL, "title_raw", "title_clean", "ptitle_raw", "ptitle_clean", "all_terms", "lexicon", "lemmas",
    *_FORM_STEMS, "forms", "body_forms", "title_forms", "ptitle_forms",
]
INDEXED = [*FORMED, "vocab"]


def _vectors(name: str, tokens: str) -> list[str]:
    """Pairs, counts, idf, and the two averaged vectors of one token table."""
    CTES[f"{name}_pairs"] = (
        f"SELECT doc_id, term, count(*) AS tf FROM {tokens} GROUP BY doc_id, term"
    )
    CTES[f"{name}_counts"] = (
        f"SELECT p.doc_id, v.idx, p.tf FROM {name}_pairs p JOIN vocab v ON v.term = p.term"
    )
    CTES[f"{name}_idf"] = f"""
        SELECT term, ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + count(*))) + 1 AS idf
        FROM {name}_pairs GROUP BY term"""
    CTES[f"{name}_cells"] = f"""
        SELECT p.doc_id, p.tf, p.tf * p.tf * i.idf AS w,
               unnest(range(len(e.vector))) AS dim, CAST(unnest(e.vector) AS DOUBLE) AS x
        FROM {name}_pairs p JOIN embedded e ON e.term = p.term JOIN {name}_idf i ON i.term = p.term"""
    for kind, weight in (("mean", "tf"), ("weighted", "w")):
        CTES[f"{name}_{kind}"] = f"""
            SELECT d.doc_id, g.dim, coalesce(a.value, 0.0) AS value
            FROM documents d
            CROSS JOIN (SELECT unnest(range(max(len(embedding)))) AS dim FROM embeddings) g
            LEFT JOIN (SELECT doc_id, dim, sum({weight} * x) / sum({weight}) AS value
                       FROM {name}_cells GROUP BY doc_id, dim) a
                   ON a.doc_id = d.doc_id AND a.dim = g.dim"""
    return [f"{name}_pairs", f"{name}_idf", f"{name}_cells"]


BODY = [*INDEXED, "embedded", *_vectors("body", "body_forms")]
TITLE = [*INDEXED, "embedded", *_vectors("title", "title_forms")]
PTITLE = list(INDEXED)
_vectors("ptitle", "ptitle_forms")

CTES |= {
    "filled": """
        SELECT doc_id, coalesce(price, (SELECT quantile_cont(price, 0.5) FROM reviews)) AS price,
               coalesce(avg_product_rating,
                        (SELECT quantile_cont(avg_product_rating, 0.5) FROM reviews))
                   AS avg_product_rating
        FROM reviews""",
    "brands": """
        SELECT brand_name, row_number() OVER (ORDER BY brand_name) - 1 AS code
        FROM (SELECT DISTINCT brand_name FROM reviews)""",
    "products": """
        SELECT product_title, row_number() OVER (ORDER BY product_title) - 1 AS code
        FROM (SELECT DISTINCT coalesce(product_title, 'unknown') AS product_title FROM reviews)""",
    "coded": """
        SELECT r.*, b.code AS brand_encoded, p.code AS product_encoded
        FROM reviews r JOIN brands b ON b.brand_name = r.brand_name
        JOIN products p ON p.product_title = coalesce(r.product_title, 'unknown')""",
    "scaled": """
        SELECT doc_id, unnest([0, 1]) AS idx, unnest([
               (avg_product_rating - avg(avg_product_rating) OVER ())
                   / stddev_pop(avg_product_rating) OVER (),
               (lp - avg(lp) OVER ()) / stddev_pop(lp) OVER ()]) AS value
        FROM (SELECT doc_id, avg_product_rating, ln(1 + price) AS lp FROM filled)""",
    "brand_cells": """
        SELECT r.doc_id, b.code AS idx, 1.0::DOUBLE AS value
        FROM reviews r JOIN brands b ON b.brand_name = r.brand_name""",
    "meta": """
        SELECT * FROM brand_cells
        UNION ALL SELECT doc_id, idx + (SELECT count(*) FROM brands), tf FROM ptitle_counts
        UNION ALL SELECT doc_id, idx + (SELECT count(*) FROM brands) + (SELECT count(*) FROM vocab),
                         value FROM scaled""",
    "numbers": """
        SELECT doc_id, is_a_buyer, unnest(['review_rating', 'price', 'avg_product_rating',
               'product_rating_count']) AS "column",
               unnest([review_rating, price, avg_product_rating,
                       CAST(product_rating_count AS DOUBLE)]) AS value
        FROM reviews""",
    "preds": """
        SELECT CAST(doc_id % 27 AS INTEGER) AS config,
               CAST((doc_id // 27) % 5 AS INTEGER) AS fold, doc_id, quality AS label,
               toxic AS prediction, (doc_id * 37 % 101) / 101.0::DOUBLE AS score
        FROM labels""",
}
METADATA = [*PTITLE, "ptitle_pairs", "ptitle_counts", "brands", "brand_cells", "filled", "scaled", "meta"]


def _scores(by: str) -> tuple[str, str]:
    """Macro metrics and AUC of ``preds`` per the given columns."""
    macro = f"""
        SELECT {by}, sum(hits) * 1.0::DOUBLE / sum(actual) AS accuracy,
               avg(CASE WHEN predicted = 0 THEN 0 ELSE hits * 1.0::DOUBLE / predicted END)
                   AS macro_precision,
               avg(CASE WHEN actual = 0 THEN 0 ELSE hits * 1.0::DOUBLE / actual END) AS macro_recall,
               avg(2.0::DOUBLE * hits / (actual + predicted)) AS macro_f1
        FROM (SELECT {by}, class, sum(actual) AS actual, sum(predicted) AS predicted,
                     sum(hits) AS hits
              FROM (SELECT {by}, label AS class, 1 AS actual, 0 AS predicted,
                           CASE WHEN label = prediction THEN 1 ELSE 0 END AS hits FROM preds
                    UNION ALL SELECT {by}, prediction, 0, 1, 0 FROM preds)
              GROUP BY {by}, class)
        GROUP BY {by}"""
    auc = f"""
        SELECT {by}, (sum(CASE WHEN label = 1 THEN place END) - np * (np + 1) / 2.0::DOUBLE)
                     / nullif(np * nn, 0) AS roc_auc
        FROM (SELECT {by}, label,
                     rank() OVER (PARTITION BY {by} ORDER BY score)
                     + (count(*) OVER (PARTITION BY {by}, score) - 1) / 2.0::DOUBLE AS place,
                     sum(label) OVER (PARTITION BY {by}) AS np,
                     sum(1 - label) OVER (PARTITION BY {by}) AS nn
              FROM preds)
        GROUP BY {by}, np, nn"""
    return macro, auc


CTES["macro_by_fold"], CTES["auc_by_fold"] = _scores("config, fold")
_, CTES["auc_by_config"] = _scores("config")


def _list(names) -> str:
    return "[" + ", ".join(_quoted(n) for n in names) + "]"


CTES |= {
    "summary": f"""
        SELECT config, {", ".join(f"avg({m}) AS {m}" for m in METRICS)}, count(roc_auc) AS auc_folds
        FROM macro_by_fold JOIN auc_by_fold USING (config, fold) GROUP BY config""",
    "results": f"""
        SELECT {_list(SCOPES)}[config // 9 + 1] AS scope,
               {_list(REPRESENTATIONS)}[config // 3 % 3 + 1] AS representation,
               {_list(MODELS)}[config % 3 + 1] AS model, {", ".join(METRICS)}, config
        FROM summary""",
}
SUMMARY = ["preds", "macro_by_fold", "auc_by_fold", "summary"]
RESULTS = [*SUMMARY, "results"]


def near(expression: str, places: int = 6) -> str:
    return f"round({expression}, {places}) + 0.0"


def _sql(ctes: list[str], body: str) -> str:
    parts = ", ".join(f"{name} AS ({CTES[name]})" for name in dict.fromkeys(ctes))
    return f"WITH {parts} {body}"


def _shown(ctes: list[str], tokens: str) -> str:
    return _sql(
        ctes,
        f"""SELECT d.doc_id, count(t.term) AS n_tokens,
                   coalesce(string_agg(t.term, ' ' ORDER BY t.pos), '') AS tokens
            FROM documents d LEFT JOIN {tokens} t ON t.doc_id = d.doc_id GROUP BY d.doc_id""",
    )


def _metrics(extra: str = "") -> str:
    return ", ".join(f"{near(m)} AS {m}" for m in METRICS) + extra


def _cell(metric: str, conditions: str) -> str:
    return near(f"avg(CASE WHEN {conditions} THEN {metric} END)")


def _column_name(*parts: str) -> str:
    return "_".join(p.lower().replace("-", "_").replace(" ", "_") for p in parts)


def _dims(name: str) -> str:
    return f"SELECT doc_id, dim, {near('value')} AS value FROM {name}"


_long_tokens = "(SELECT * FROM body_raw WHERE length(term) >= 2)"
_stages = [
    ("all tokens", "TRUE"),
    ("without short words", "length(term) >= 2"),
    (
        "without stop words",
        "length(term) >= 2 AND term NOT IN (SELECT word FROM stop)",
    ),
]
CTES["all_freq"] = (
    "SELECT term, count(*) AS cnt, count(DISTINCT doc_id) AS df FROM body_raw GROUP BY term"
)
_stage_rows = [
    f"""SELECT {i + 1} AS step_no, {_quoted(name)} AS step, sum(cnt) AS total, count(*) AS terms
        FROM all_freq WHERE {condition}"""
    for i, (name, condition) in enumerate(_stages)
] + [
    """SELECT 4, 'without singletons', sum(cnt), count(*)
       FROM freq WHERE cnt > 1""",
    """SELECT 5, 'without the 20 most common', sum(cnt), count(*)
       FROM freq WHERE cnt > 1 AND term NOT IN (SELECT term FROM top)""",
]
CTES["stages"] = " UNION ALL ".join(_stage_rows)

_boxes = ", ".join(
    f"quantile_cont(value, {p}) AS {n}" for n, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))
)
_correlated = [
    "review_rating",
    "price",
    "avg_product_rating",
    "product_rating_count",
    "brand_encoded",
    "product_encoded",
    "is_a_buyer",
]
CTES["corr_input"] = "SELECT " + ", ".join(
    f"coalesce(CAST({c} AS DOUBLE), (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) FROM coded)) AS {c}"
    if c != "is_a_buyer"
    else """coalesce(CAST(CAST(is_a_buyer AS INTEGER) AS DOUBLE),
            (SELECT quantile_cont(CAST(CAST(is_a_buyer AS INTEGER) AS DOUBLE), 0.5) FROM coded))
            AS is_a_buyer"""
    for c in _correlated
) + " FROM coded"
CTES["matrix"] = " UNION ALL ".join(
    f"""SELECT {_quoted(a)} AS a, {_quoted(b)} AS b,
        CASE WHEN stddev_pop({a}) * stddev_pop({b}) > 0
             THEN covar_pop({a}, {b}) / (stddev_pop({a}) * stddev_pop({b})) END AS r
        FROM corr_input"""
    for a in _correlated
    for b in _correlated
)
CORRELATED = ["reviews", "brands", "products", "coded", "corr_input", "matrix"]

_review_columns = [
    "doc_id", "review_id", "product_id", "review_title", "review_text", "review_rating",
    "review_date", "author", "is_a_buyer", "price", "avg_product_rating", "product_rating_count",
    "brand_name", "product_title", "product_url", "product_tags",
]
_bounds = """(SELECT "column", min(value) AS low, max(value) AS high FROM numbers GROUP BY "column")"""


def _entries(name: str, kind: str) -> str:
    """One text block as (doc_id, idx, value)."""
    if kind == "counts":
        return f"SELECT doc_id, idx, CAST(tf AS DOUBLE) AS value FROM {name}_counts"
    return f"SELECT doc_id, dim AS idx, value FROM {name}_{kind} WHERE value != 0"


def _scope_rows() -> str:
    parts = []
    for kind, representation in zip(("counts", "mean", "weighted"), REPRESENTATIONS):
        one = "(SELECT count(*) FROM vocab)" if kind == "counts" else (
            "(SELECT max(len(embedding)) FROM embeddings)"
        )
        meta = "(SELECT count(*) FROM brands) + (SELECT count(*) FROM vocab) + 2"
        widths = (one, f"2 * {one}", f"2 * {one} + {meta}")
        blocks = [_entries("body", kind), _entries("title", kind)]
        blocks.append("SELECT doc_id, idx, value FROM meta WHERE value != 0")
        for i, scope in enumerate(SCOPES):
            union = " UNION ALL ".join(blocks[: i + 1])
            parts.append(
                f"""SELECT {_quoted(scope)} AS scope, {_quoted(representation)} AS representation,
                    l.doc_id, CAST({widths[i]} AS BIGINT) AS n_columns, count(e.idx) AS nonzeros,
                    {near("coalesce(sum(e.value), 0.0)", 3)} AS total
                    FROM documents l LEFT JOIN ({union}) e ON e.doc_id = l.doc_id GROUP BY l.doc_id"""
            )
    return " UNION ALL ".join(parts)


ORACLES: dict[str, str] = {
    "preprocess_summary": _sql(
        [*TEXT, "freq", "top", "all_freq", "stages"],
        """SELECT CAST(step_no AS INTEGER) AS step_no, step, CAST(total AS BIGINT) AS total_tokens,
                  CAST(coalesce(lag(total) OVER (ORDER BY step_no) - total, 0) AS BIGINT)
                      AS tokens_removed,
                  round(100.0::DOUBLE * total / first_value(total) OVER (ORDER BY step_no), 2)
                      AS percent_remaining,
                  terms AS distinct_terms,
                  round(total::DOUBLE / (SELECT count(*) FROM documents), 2) AS mean_tokens
           FROM stages""",
    ),
    "tokenize": _shown(["reviews", "body_raw"], "body_raw"),
    "length_filter": _shown(["reviews", "body_raw"], _long_tokens),
    "stopword_filter": _shown(TEXT, "body_clean"),
    "hapax_filter": _shown([*TEXT, "freq", "body_common"], "body_common"),
    "topdf_filter": _shown(FINAL, "body_final"),
    "clean_titles": _shown(FORMED, "title_forms"),
    "term_freq": _sql([*TEXT, "freq"], "SELECT term, cnt FROM freq"),
    "hapax_terms": _sql([*TEXT, "freq"], "SELECT term FROM freq WHERE cnt = 1"),
    "doc_freq": _sql([*TEXT, "freq"], "SELECT term, df FROM freq WHERE cnt > 1"),
    "top_df_terms": _sql([*TEXT, "freq", "top"], "SELECT term, df FROM top"),
    "processed_reviews": _sql(
        FORMED,
        "SELECT "
        + ", ".join(
            {
                "review_text": "coalesce(t.words, '') AS review_text",
                "avg_product_rating": f"{near('avg_product_rating')} AS avg_product_rating",
                "doc_id": "r.doc_id",
            }.get(c, c)
            for c in _review_columns
        )
        + """, coalesce(t.n, 0) AS n_tokens
           FROM reviews r LEFT JOIN (
               SELECT doc_id, string_agg(term, ' ' ORDER BY pos) AS words, count(*) AS n
               FROM body_forms GROUP BY doc_id) t ON t.doc_id = r.doc_id""",
    ),
    "title_token_stats": _sql(
        ["reviews", "stop", "title_raw", "title_clean"],
        f"""SELECT count(*) AS n, count(*) FILTER (n_tokens = 0) AS empty,
                   {near("quantile_cont(n_tokens, 0.5)")} AS median_tokens
            FROM (SELECT d.doc_id, count(t.term) AS n_tokens FROM documents d
                  LEFT JOIN title_clean t ON t.doc_id = d.doc_id GROUP BY d.doc_id)""",
    ),
    "stopword_table": _sql(["reviews", "body_raw"], "SELECT DISTINCT term AS word FROM body_raw"),
    "build_vocab": _sql(INDEXED, "SELECT term, idx FROM vocab"),
    "vocab_roundtrip": _sql(INDEXED, "SELECT term, idx FROM vocab"),
    "vocab_check": _sql(
        INDEXED,
        """SELECT count(*) AS n_terms, min(idx) AS min_idx, max(idx) AS max_idx,
                  count(DISTINCT idx) AS n_indexes,
                  count(*) FILTER (following <= term) AS out_of_order,
                  min(idx) = 0 AND max(idx) = count(*) - 1 AND count(DISTINCT idx) = count(*)
                      AND count(*) FILTER (following <= term) = 0 AS valid
           FROM (SELECT term, idx, lead(term) OVER (ORDER BY idx) AS following FROM vocab)""",
    ),
    "lemma_map": _sql([*TEXT, "freq", "lexicon"], _lemmas("freq", "lexicon")),
    "stem_map": _sql([*TEXT, "freq", *_TERM_STEMS], "SELECT word AS term, stem FROM term_stems"),
    "form_map": _sql(FORMED, "SELECT term, form FROM forms"),
    "consolidate": _sql(
        FORMED,
        "SELECT term, count(*) AS cnt, count(DISTINCT doc_id) AS df FROM body_forms GROUP BY 1",
    ),
    "count_vectors": _sql([*BODY, "body_counts"], "SELECT doc_id, idx, tf FROM body_counts"),
    "title_count_vectors": _sql([*TITLE, "title_counts"], "SELECT * FROM title_counts"),
    "ptitle_count_vectors": _sql(
        [*PTITLE, "ptitle_pairs", "ptitle_counts"], "SELECT * FROM ptitle_counts"
    ),
    "tfidf": _sql(
        [*FORMED, "body_pairs", "body_idf"],
        f"""SELECT doc_id, term,
                   {near("raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id))")} AS weight
            FROM (SELECT p.doc_id, p.term, p.tf * i.idf AS raw
                  FROM body_pairs p JOIN body_idf i ON i.term = p.term)""",
    ),
    "word_vector_scan": _sql(
        [*INDEXED, "embedded"],
        f"""SELECT term, CAST(len(vector) AS BIGINT) AS width,
                   {near("CAST(vector[1] AS DOUBLE)")} AS first_value FROM embedded""",
    ),
    "mean_vectors": _sql([*BODY, "body_mean"], _dims("body_mean")),
    "weighted_vectors": _sql([*BODY, "body_weighted"], _dims("body_weighted")),
    "title_mean_vectors": _sql([*TITLE, "title_mean"], _dims("title_mean")),
    "title_weighted_vectors": _sql([*TITLE, "title_weighted"], _dims("title_weighted")),
    "count_vec_lines": _sql(
        [*BODY, "body_counts"],
        """SELECT d.doc_id, '#' || d.doc_id || ','
                  || coalesce(string_agg(c.idx || ':' || c.tf, ',' ORDER BY c.idx), '') AS line
           FROM documents d LEFT JOIN body_counts c ON c.doc_id = d.doc_id GROUP BY d.doc_id""",
    ),
    "count_vec_roundtrip": _sql([*BODY, "body_counts"], "SELECT doc_id, idx, tf FROM body_counts"),
    "dense_vec_lines": _sql(
        [*BODY, "body_mean"],
        """SELECT doc_id, '#' || doc_id || ',' || string_agg(
                  replace(printf('%.6f', value), '-0.000000', '0.000000'), ',' ORDER BY dim) AS line
           FROM body_mean GROUP BY doc_id""",
    ),
    "weighted_vec_lines": _sql(
        [*BODY, "body_weighted"],
        """SELECT doc_id, '#' || doc_id || ',' || string_agg(
                  replace(printf('%.6f', value), '-0.000000', '0.000000'), ',' ORDER BY dim) AS line
           FROM body_weighted GROUP BY doc_id""",
    ),
    "dense_vec_roundtrip": _sql([*BODY, "body_mean"], _dims("body_mean")),
    "scan_reviews": _sql(
        ["reviews"],
        "SELECT "
        + ", ".join(
            {
                "avg_product_rating": f"{near('avg_product_rating')} AS avg_product_rating",
            }.get(c, c)
            for c in _review_columns
        )
        + " FROM reviews",
    ),
    "sample_rows": _sql(
        ["reviews"],
        "SELECT doc_id, review_title, is_a_buyer FROM reviews ORDER BY doc_id LIMIT 5",
    ),
    "null_profile": _sql(
        ["reviews"],
        " UNION ALL ".join(
            f"""SELECT {_quoted(c)} AS "column", count(*) FILTER ({c} IS NULL) AS nulls,
                count(*) AS total FROM reviews"""
            for c in _review_columns
        ),
    ),
    "date_filter": _sql(
        ["reviews"],
        f"""SELECT doc_id, review_date FROM reviews
            WHERE year(try_strptime(review_date, '%d-%m-%Y')) >= {CUTOFF_YEAR}""",
    ),
    "date_filter_report": _sql(
        ["reviews"],
        f"""SELECT count(*) AS total, count(*) FILTER (y >= {CUTOFF_YEAR}) AS kept,
                   count(*) - count(*) FILTER (y >= {CUTOFF_YEAR}) AS dropped,
                   count(*) FILTER (y IS NULL) AS without_date
            FROM (SELECT year(try_strptime(review_date, '%d-%m-%Y')) AS y FROM reviews)""",
    ),
    "label_map": "SELECT doc_id, CASE WHEN quality = 1 THEN 1 ELSE 0 END AS label FROM labels",
    "class_balance": f"""
        SELECT count(*) AS n, {near("avg(quality)")} AS positive,
               {near("1 - avg(quality)")} AS negative FROM labels""",
    "class_counts": "SELECT quality AS label, count(*) AS n FROM labels GROUP BY quality",
    "rating_by_class": _sql(
        ["reviews"],
        """SELECT review_rating, is_a_buyer, count(*) AS n FROM reviews
           WHERE is_a_buyer IS NOT NULL GROUP BY ALL""",
    ),
    "ordinal_encode": _sql(
        ["reviews", "brands", "products", "coded"],
        "SELECT doc_id, brand_encoded, product_encoded FROM coded",
    ),
    "median_impute": _sql(
        ["reviews", "filled"],
        f"""SELECT doc_id, {near("price")} AS price, {near("avg_product_rating")} AS avg_product_rating
            FROM filled""",
    ),
    "numeric_features": _sql(
        ["reviews", "filled"],
        f"""SELECT doc_id,
                   {near('''(avg_product_rating - avg(avg_product_rating) OVER ())
                            / stddev_pop(avg_product_rating) OVER ()''')} AS avg_product_rating,
                   {near("(lp - avg(lp) OVER ()) / stddev_pop(lp) OVER ()")} AS log_price
            FROM (SELECT doc_id, avg_product_rating, ln(1 + price) AS lp FROM filled)""",
    ),
    "corr_matrix": _sql(CORRELATED, f"SELECT a, b, {near('r')} AS r FROM matrix"),
    "corr_target": _sql(
        CORRELATED,
        f"""SELECT a AS feature, {near('r')} AS r FROM matrix
            WHERE b = 'is_a_buyer' AND a != 'is_a_buyer'""",
    ),
    "dist_by_class": _sql(
        ["reviews", "numbers"],
        f"""SELECT "column", class, {near("q1")} AS q1, {near("median")} AS median,
                   {near("q3")} AS q3, count(value) AS n, {near("min(value)")} AS low,
                   {near("max(value)")} AS high,
                   {near("min(value) FILTER (value >= q1 - 1.5 * (q3 - q1))")} AS whisker_low,
                   {near("max(value) FILTER (value <= q3 + 1.5 * (q3 - q1))")} AS whisker_high
            FROM (SELECT "column", CAST(is_a_buyer AS VARCHAR) AS class, value FROM numbers
                  WHERE is_a_buyer IS NOT NULL) n
            JOIN (SELECT "column", CAST(is_a_buyer AS VARCHAR) AS class, {_boxes} FROM numbers
                  WHERE is_a_buyer IS NOT NULL GROUP BY ALL) b USING ("column", class)
            GROUP BY "column", class, b.q1, b.median, b.q3""",
    ),
    "hist_by_class": _sql(
        ["reviews", "numbers"],
        f"""SELECT "column", CAST(is_a_buyer AS VARCHAR) AS class,
                   CAST(least(coalesce(floor((value - low) * 20 / nullif(high - low, 0)), 0), 19)
                        AS BIGINT) AS bin, count(*) AS n
            FROM numbers JOIN {_bounds} USING ("column")
            WHERE is_a_buyer IS NOT NULL AND value IS NOT NULL GROUP BY ALL""",
    ),
    "top_brand_rate": _sql(
        ["reviews"],
        f"""SELECT brand_name, n, {near("rate")} AS rate,
                   {near("(SELECT avg(CAST(is_a_buyer AS INTEGER)) FROM reviews)")} AS overall_rate
            FROM (SELECT brand_name, count(*) AS n, avg(CAST(is_a_buyer AS INTEGER)) AS rate
                  FROM reviews GROUP BY brand_name ORDER BY n DESC, brand_name LIMIT 15)""",
    ),
    "yearly_counts": _sql(
        ["reviews"],
        """SELECT CAST(year(strptime(review_date, '%d-%m-%Y')) AS INTEGER) AS year,
                  count(*) FILTER (is_a_buyer) AS n_true, count(*) FILTER (NOT is_a_buyer) AS n_false
           FROM reviews WHERE is_a_buyer IS NOT NULL GROUP BY 1""",
    ),
    "yearly_rate": _sql(
        ["reviews"],
        f"""SELECT CAST(year(strptime(review_date, '%d-%m-%Y')) AS INTEGER) AS year,
                   {near("avg(CAST(is_a_buyer AS INTEGER))")} AS rate,
                   {near("1 - avg(CAST(is_a_buyer AS INTEGER))")} AS other_rate
            FROM reviews GROUP BY 1""",
    ),
    "brand_one_hot": _sql(["reviews", "brands", "brand_cells"], "SELECT * FROM brand_cells"),
    "metadata_block": _sql(METADATA, f"SELECT doc_id, idx, {near('value')} AS value FROM meta"),
    "labelled_features": _sql(
        [*BODY, "body_counts"],
        """SELECT c.doc_id, c.idx, c.tf, l.quality AS label
           FROM body_counts c JOIN labels l ON l.doc_id = c.doc_id""",
    ),
    "feature_stats": _sql(
        [*BODY, *TITLE, *METADATA, "body_counts", "title_counts"],
        """SELECT block, (SELECT count(*) FROM documents) AS n_rows,
                  CAST(widths * (SELECT count(*) FROM vocab)
                       + CASE WHEN contains(block, 'metadata') THEN (SELECT count(*) FROM brands) + 2
                              ELSE 0 END AS BIGINT) AS n_columns,
                  count(*) AS nonzeros, count(DISTINCT doc_id) AS rows_filled
           FROM (SELECT 'body' AS block, 1 AS widths, doc_id FROM body_counts
                 UNION ALL SELECT 'title', 1, doc_id FROM title_counts
                 UNION ALL SELECT 'metadata', 1, doc_id FROM meta WHERE value != 0
                 UNION ALL SELECT 'body_title', 2, doc_id FROM body_counts
                 UNION ALL SELECT 'body_title', 2, doc_id FROM title_counts
                 UNION ALL SELECT 'body_title_metadata', 3, doc_id FROM body_counts
                 UNION ALL SELECT 'body_title_metadata', 3, doc_id FROM title_counts
                 UNION ALL SELECT 'body_title_metadata', 3, doc_id FROM meta WHERE value != 0)
           GROUP BY block, widths""",
    ),
    "feature_scopes": _sql(
        [*BODY, *TITLE, *METADATA, "body_counts", "title_counts", "body_mean", "body_weighted",
         "title_mean", "title_weighted"],
        _scope_rows(),
    ),
    "stratified_folds": """
        SELECT doc_id, label, CAST((row_number() OVER (PARTITION BY label
                   ORDER BY doc_id * 7919 % 10007, doc_id) - 1) % 5 AS INTEGER) AS fold
        FROM (SELECT doc_id, quality AS label FROM labels)""",
    "macro_metrics": _sql(
        ["preds", "macro_by_fold"],
        "SELECT config, fold, "
        + ", ".join(f"{near(m)} AS {m}" for m in METRICS[:4])
        + " FROM macro_by_fold",
    ),
    "roc_auc": _sql(
        ["preds", "auc_by_config"], f"SELECT config, {near('roc_auc')} AS roc_auc FROM auc_by_config"
    ),
    "cv_summary": _sql(SUMMARY, f"SELECT config, {_metrics()}, auc_folds FROM summary"),
    "all_results": _sql(RESULTS, f"SELECT scope, representation, model, {_metrics()} FROM results"),
    "metric_pivot": _sql(
        RESULTS,
        "SELECT representation, "
        + ", ".join(
            f"{_cell('macro_f1', f'model = {_quoted(m)}')} AS {_column_name(m)}" for m in MODELS
        )
        + " FROM results GROUP BY representation",
    ),
    "scope_pivot": _sql(
        RESULTS,
        "SELECT scope, "
        + ", ".join(
            _cell("macro_f1", f"representation = {_quoted(r)} AND model = {_quoted(m)}")
            + f" AS {_column_name(r, m)}"
            for r in REPRESENTATIONS
            for m in MODELS
        )
        + " FROM results GROUP BY scope",
    ),
    "rank_configs": _sql(
        RESULTS,
        f"""SELECT scope, representation, model, {_metrics()} FROM results
            ORDER BY round(macro_f1, 9) DESC, config""",
    ),
    "best_config": _sql(
        RESULTS,
        f"""SELECT scope, representation, model, {_metrics()} FROM results
            ORDER BY round(results.macro_f1, 9) DESC NULLS LAST, config LIMIT 1""",
    ),
    "lift_by_scope": _sql(
        RESULTS,
        f"""SELECT scope, representation, model, {near("macro_f1")} AS value,
                   {near('''macro_f1 - first_value(macro_f1)
                            OVER (PARTITION BY representation, model ORDER BY config)''')} AS lift
            FROM results""",
    ),
}

_types = {
    "doc_id": "bigint", "review_rating": "double", "is_a_buyer": "boolean", "price": "double",
    "avg_product_rating": "double", "product_rating_count": "bigint",
}
_asked = [
    "doc_id", "review_id", "product_id", "review_title", "review_text", "review_rating", "review_date",
    "author", "is_a_buyer", "price", "avg_product_rating", "product_rating_count", "brand_name",
    "product_title", "product_url", "product_tags",
]
ORACLES["table_profile"] = f"""
    SELECT CAST(place AS INTEGER) AS place, "column", type,
           (SELECT count(*) FROM documents) AS n_rows, 16::BIGINT AS n_columns
    FROM (VALUES {_rows(*[(i, c, _types.get(c, "string")) for i, c in enumerate(_asked)])})
         AS t(place, "column", type)"""
ORACLES["one_config"] = _sql(
    RESULTS,
    f"""SELECT scope, representation, model, {_metrics()} FROM results
        WHERE scope = 'Body + Title' AND representation = 'Count' AND model = 'Random Forest'""",
)


def _lines(name: str) -> str:
    return f"""
        SELECT doc_id, '#' || doc_id || ',' || string_agg(
               replace(printf('%.6f', value), '-0.000000', '0.000000'), ',' ORDER BY dim) AS line
        FROM {name} GROUP BY doc_id"""


# The same subqueries over the documents after the date cut.
_whole = _sql(
    [*BODY, "body_counts", "body_mean", "body_weighted"],
    "SELECT "
    + ", ".join(
        {
            "review_text": "coalesce(t.words, '') AS review_text",
            "avg_product_rating": f"{near('avg_product_rating')} AS avg_product_rating",
            "doc_id": "r.doc_id",
        }.get(c, f"r.{c}")
        for c in _review_columns
    )
    + f""", '#' || r.doc_id || ',' || coalesce(c.line, '') AS count_line, m.line AS mean_line,
           w.line AS weighted_line
       FROM reviews r
       LEFT JOIN (SELECT doc_id, string_agg(term, ' ' ORDER BY pos) AS words
                  FROM body_forms GROUP BY doc_id) t ON t.doc_id = r.doc_id
       LEFT JOIN (SELECT doc_id, string_agg(idx || ':' || tf, ',' ORDER BY idx) AS line
                  FROM body_counts GROUP BY doc_id) c ON c.doc_id = r.doc_id
       LEFT JOIN ({_lines("body_mean")}) m ON m.doc_id = r.doc_id
       LEFT JOIN ({_lines("body_weighted")}) w ON w.doc_id = r.doc_id""",
).replace("FROM documents", "FROM cut_documents")
ORACLES["workflow"] = _whole.replace(
    "WITH ",
    f"""WITH cut_documents AS (
        SELECT d.* FROM documents d JOIN orders o ON o.o_orderkey = d.doc_id
        WHERE year(o.o_orderdate) >= {CUTOFF_YEAR}), """,
    1,
)

CTES["dealt"] = """
    SELECT doc_id, label, CAST((row_number() OVER (PARTITION BY label
               ORDER BY doc_id * 7919 % 10007, doc_id) - 1) % 5 AS INTEGER) AS fold
    FROM (SELECT doc_id, quality AS label FROM labels)"""
CTES["two_numbers"] = """
    SELECT f.doc_id, d.label, d.fold,
           (avg_product_rating - a.m1) / a.s1 AS x1, (ln(1 + price) - a.m2) / a.s2 AS x2
    FROM filled f JOIN dealt d ON d.doc_id = f.doc_id, (
        SELECT avg(avg_product_rating) AS m1, stddev_pop(avg_product_rating) AS s1,
               avg(ln(1 + price)) AS m2, stddev_pop(ln(1 + price)) AS s2 FROM filled) a"""
# Newton steps for the penalised likelihood of three weights, for each fold left out: the sums of a
# step, and the step by Cramer's rule. The intercept b0 has no penalty.
CTES["newton"] = """
    SELECT g.f AS f, 0 AS i, 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2
    FROM (SELECT DISTINCT fold AS f FROM dealt) g
    UNION ALL
    SELECT f, i + 1,
           b0 + (g0 * (h11 * h22 - h12 * h12) - h01 * (g1 * h22 - h12 * g2) + h02 * (g1 * h12 - h11 * g2)) / det,
           b1 + (h00 * (g1 * h22 - h12 * g2) - g0 * (h01 * h22 - h12 * h02) + h02 * (h01 * g2 - g1 * h02)) / det,
           b2 + (h00 * (h11 * g2 - g1 * h12) - h01 * (h01 * g2 - g1 * h02) + g0 * (h01 * h12 - h11 * h02)) / det
    FROM (SELECT *, h00 * (h11 * h22 - h12 * h12) - h01 * (h01 * h22 - h12 * h02)
                    + h02 * (h01 * h12 - h11 * h02) AS det
          FROM (SELECT f, i, b0, b1, b2, sum(label - p) AS g0, sum((label - p) * x1) - b1 AS g1,
                       sum((label - p) * x2) - b2 AS g2, sum(p * (1 - p)) AS h00,
                       sum(p * (1 - p) * x1) AS h01, sum(p * (1 - p) * x2) AS h02,
                       sum(p * (1 - p) * x1 * x1) + 1 AS h11, sum(p * (1 - p) * x1 * x2) AS h12,
                       sum(p * (1 - p) * x2 * x2) + 1 AS h22
                FROM (SELECT n.*, t.label, t.x1, t.x2,
                             1 / (1 + exp(-(b0 + b1 * t.x1 + b2 * t.x2))) AS p
                      FROM newton n JOIN two_numbers t ON t.fold <> n.f WHERE n.i < 15)
                GROUP BY f, i, b0, b1, b2))"""
CTES["lr_scored"] = """
    SELECT t.doc_id, CAST(t.label AS INTEGER) AS label, b0 + b1 * x1 + b2 * x2 AS margin, t.fold
    FROM two_numbers t JOIN newton n ON n.f = t.fold AND n.i = 15"""
NEWTON = ["reviews", "filled", "dealt", "two_numbers", "newton", "lr_scored"]


def _recursive(ctes: list[str], body: str) -> str:
    return _sql(ctes, body).replace("WITH ", "WITH RECURSIVE ", 1)


ORACLES["lr_numbers"] = _recursive(
    NEWTON,
    f"""SELECT doc_id, label, CAST(margin > 0 AS INTEGER) AS prediction, {near("margin", 4)} AS score,
               fold FROM lr_scored""",
)
CTES["cv_preds"] = """
    SELECT fold, label, CAST(margin > 0 AS INTEGER) AS prediction, round(margin, 9) AS score
    FROM lr_scored"""
_macro, _auc = (sql.replace("FROM preds", "FROM cv_preds") for sql in _scores("fold"))
CTES |= {"cv_macro": _macro, "cv_auc": _auc}
ORACLES["cv_numbers"] = _recursive(
    [*NEWTON, "cv_preds", "cv_macro", "cv_auc"],
    f"SELECT fold, {_metrics()} FROM cv_macro JOIN cv_auc USING (fold)",
)
# One split by exact Gini gain over the midpoints of neighbouring values; two sides with one
# prediction are one leaf.
CTES |= {
    "variety": """
        SELECT r.doc_id, r.review_rating AS x2, d.label, d.fold,
               CAST(floor(coalesce(t.share, 0)) AS DOUBLE) AS x1
        FROM reviews r JOIN dealt d ON d.doc_id = r.doc_id LEFT JOIN (
            SELECT doc_id, 10.0::DOUBLE * count(DISTINCT term) / count(*) AS share
            FROM body_raw GROUP BY doc_id) t ON t.doc_id = r.doc_id""",
    "values_seen": """
        SELECT f, j, v, count(*) AS n, sum(label) AS n1
        FROM (SELECT g.f, unnest([1, 2]) AS j, unnest([x1, x2]) AS v, label
              FROM variety JOIN (SELECT DISTINCT fold AS f FROM dealt) g ON g.f <> fold)
        GROUP BY f, j, v""",
    "splits": """
        SELECT f, j, (v + lead(v) OVER w) / 2 AS t, sum(n) OVER w AS nl, sum(n1) OVER w AS l1,
               sum(n) OVER (PARTITION BY f, j) AS n, sum(n1) OVER (PARTITION BY f, j) AS n1
        FROM values_seen WINDOW w AS (PARTITION BY f, j ORDER BY v)""",
    "gains": """
        SELECT *, 2.0::DOUBLE * n1 / n * (1 - n1 / n)
                  - 2.0::DOUBLE * l1 / nl * (1 - l1 / nl) * nl / n
                  - 2.0::DOUBLE * (n1 - l1) / (n - nl) * (1 - (n1 - l1) / (n - nl)) * (n - nl) / n AS gain
        FROM (SELECT f, j, t, nl::DOUBLE AS nl, l1::DOUBLE AS l1, n::DOUBLE AS n, n1::DOUBLE AS n1
              FROM splits WHERE t IS NOT NULL)""",
    "stump": """
        SELECT *, l1 / nl > 0.5 AS left_one, (n1 - l1) / (n - nl) > 0.5 AS right_one FROM gains
        QUALIFY row_number() OVER (PARTITION BY f ORDER BY round(gain, 12) DESC, j, t) = 1""",
}
ORACLES["dt_stump"] = ORACLES["rf_one_tree"] = _sql(
    ["reviews", "body_raw", "dealt", "variety", "values_seen", "splits", "gains", "stump"],
    f"""SELECT doc_id, label, CAST(p > 0.5 AS INTEGER) AS prediction, {near("p")} AS score, fold
        FROM (SELECT v.doc_id, CAST(v.label AS INTEGER) AS label, v.fold,
                     CASE WHEN left_one = right_one OR gain <= 0 THEN n1 / n
                          WHEN CASE WHEN j = 1 THEN x1 ELSE x2 END <= t THEN l1 / nl
                          ELSE (n1 - l1) / (n - nl) END AS p
              FROM variety v JOIN stump s ON s.f = v.fold)""",
)

# At its optimum, a regression's fitted moments are those of the data, which need no fit.
CTES["left_out"] = "SELECT DISTINCT fold AS f FROM dealt"


def _moments(cells: str) -> str:
    """Sums of feature times label per training set, with -1 for the intercept."""
    return f"""
        SELECT g.f AS fold, c.idx, {near("sum(CASE WHEN d.fold <> g.f THEN c.value * d.label ELSE 0 END)")} AS observed,
               TRUE AS optimal
        FROM (SELECT doc_id, CAST(idx AS BIGINT) AS idx, CAST(value AS DOUBLE) AS value FROM {cells}
              UNION ALL SELECT doc_id, -1, 1.0 FROM dealt) c
        JOIN dealt d ON d.doc_id = c.doc_id, left_out g GROUP BY g.f, c.idx"""


ORACLES["lr_certificate"] = _sql(
    [*BODY, "body_mean", "dealt", "left_out"], _moments("(SELECT doc_id, dim AS idx, value FROM body_mean)")
)


def _tree(depth: int) -> str:
    """Trees grown by exact Gini gain to a depth; splits whose sides say the same go, from the bottom up."""
    ctes = [
        """grown0 AS (SELECT g.f, v.doc_id, v.x1, v.x2, CAST(v.label AS DOUBLE) AS label, '' AS path
           FROM variety v JOIN left_out g ON g.f <> v.fold)"""
    ]
    for i in range(depth):
        ctes += [
            f"""seen{i} AS (SELECT f, path, j, v, count(*)::DOUBLE AS n, sum(label) AS n1
                FROM (SELECT f, path, label, unnest([1, 2]) AS j, unnest([x1, x2]) AS v FROM grown{i}) GROUP BY ALL)""",
            f"""cut{i} AS (SELECT f, path, j, (v + lead(v) OVER w) / 2 AS t, sum(n) OVER w AS nl, sum(n1) OVER w AS l1,
                       sum(n) OVER (PARTITION BY f, path, j) AS n, sum(n1) OVER (PARTITION BY f, path, j) AS n1
                FROM seen{i} WINDOW w AS (PARTITION BY f, path, j ORDER BY v))""",
            f"""best{i} AS (
                SELECT *, 2 * n1 / n * (1 - n1 / n) - 2 * l1 / nl * (1 - l1 / nl) * nl / n
                       - 2 * (n1 - l1) / (n - nl) * (1 - (n1 - l1) / (n - nl)) * (n - nl) / n AS gain
                FROM cut{i} WHERE t IS NOT NULL
                QUALIFY row_number() OVER (PARTITION BY f, path ORDER BY round(gain, 12) DESC, j, t) = 1)""",
            f"""grown{i + 1} AS (
                SELECT r.f, r.doc_id, r.x1, r.x2, r.label,
                       r.path || CASE WHEN CASE WHEN j = 1 THEN x1 ELSE x2 END <= t THEN 'L' ELSE 'R' END AS path
                FROM grown{i} r JOIN best{i} b ON b.f = r.f AND b.path = r.path WHERE gain > 1e-12)""",
        ]
    for i in reversed(range(depth)):
        kept = f"SELECT f, path FROM kept{i + 1}" if i + 1 < depth else "SELECT f, path FROM grown0 WHERE FALSE"
        ctes.append(
            f"""kept{i} AS (
                SELECT b.* FROM best{i} b WHERE gain > 1e-12 AND (
                    (l1 / nl > 0.5) <> ((n1 - l1) / (n - nl) > 0.5)
                    OR EXISTS (FROM ({kept}) k WHERE k.f = b.f AND k.path IN (b.path || 'L', b.path || 'R'))))"""
        )
    all_kept = " UNION ALL ".join(f"SELECT * FROM kept{i}" for i in range(depth))
    return (
        _sql(["reviews", "body_raw", "dealt", "left_out", "variety"], "@").replace("@", "").rstrip()
        + ", "
        + ", ".join(ctes)
        + f"""
        SELECT f AS fold, path, CAST(n AS BIGINT) AS n, CAST(n1 AS BIGINT) AS ones, CAST(j - 1 AS INTEGER) AS feature,
               t AS threshold, {near("gain")} AS gain, TRUE AS best, TRUE AS same_predictions FROM ({all_kept})"""
    )


ORACLES["tree_replay"] = _tree(3)
ORACLES["infold_tfidf"] = _sql(
    [*FORMED, "body_pairs", "dealt", "left_out"],
    f"""SELECT g.f AS fold, p.term, count(*) AS df, {near("ln((1.0 + any_value(s.n)) / (1.0 + count(*))) + 1")} AS idf
        FROM body_pairs p JOIN dealt d ON d.doc_id = p.doc_id JOIN left_out g ON g.f <> d.fold
        JOIN (SELECT g.f, count(*) AS n FROM dealt d JOIN left_out g ON g.f <> d.fold GROUP BY g.f) s ON s.f = g.f
        GROUP BY g.f, p.term""",
)
_numbers = ("review_rating", "price", "avg_product_rating", "product_rating_count")
_long = (
    f"unnest([{', '.join(_quoted(c) for c in _numbers)}]) AS \"column\", "
    f"unnest([{', '.join(f'CAST({c} AS DOUBLE)' for c in _numbers)}]) AS value"
)
ORACLES["infold_numeric"] = _sql(
    ["reviews", "dealt", "left_out"],
    f"""SELECT g.f AS fold, "column", count(*) AS n, {near("avg(value)")} AS mean, {near("stddev_pop(value)")} AS std,
               {near("median(value)")} AS median
        FROM (SELECT doc_id, {_long} FROM reviews) r JOIN dealt d ON d.doc_id = r.doc_id JOIN left_out g ON g.f <> d.fold
        WHERE value IS NOT NULL GROUP BY g.f, "column\"""",
)
ORACLES["density_by_class"] = _sql(
    ["reviews"],
    f"""SELECT "column", class, CAST(point AS INTEGER) AS point, {near("x")} AS x,
               {near("sum(n * exp(-0.5 * ((x - middle) / width) ** 2)) / any_value(size * width * sqrt(2 * pi()))")} AS density
        FROM (SELECT *, low + point * (high - low) / 49 AS x, low + (bin + 0.5) * (high - low) / 400 AS middle
              FROM (SELECT "column", class, low, high, size, width, count(*) AS n,
                           least(floor((value - low) / (high - low) * 400), 399) AS bin
                    FROM (SELECT CAST(is_a_buyer AS VARCHAR) AS class, {_long} FROM reviews WHERE is_a_buyer IS NOT NULL) v
                    JOIN (SELECT "column", class, min(value) AS low, max(value) AS high, count(*)::DOUBLE AS size,
                                 stddev_samp(value) * count(*)::DOUBLE ** -0.2 AS width
                          FROM (SELECT CAST(is_a_buyer AS VARCHAR) AS class, {_long} FROM reviews)
                          WHERE value IS NOT NULL AND class IS NOT NULL GROUP BY "column", class HAVING min(value) < max(value)) s
                    USING ("column", class)
                    WHERE value IS NOT NULL GROUP BY ALL), (SELECT unnest(range(50)) AS point))
        GROUP BY "column", class, point, x""",
)
_formats = (("MM-dd-yyyy", "%m-%d-%Y"), ("dd-MM-yyyy", "%d-%m-%Y"), ("yyyy/MM/dd", "%Y/%m/%d"), ("yyyyMMdd", "%Y%m%d"))
ORACLES["elect_date_format"] = f"""
    WITH written AS (
        SELECT CASE WHEN o_orderkey % 10 < 6 THEN strftime(o_orderdate, '%d-%m-%Y')
                    WHEN o_orderkey % 10 < 8 THEN strftime(o_orderdate, '%m-%d-%Y')
                    WHEN o_orderkey % 10 < 9 THEN strftime(o_orderdate, '%Y/%m/%d') END AS w FROM orders),
    read AS (SELECT [{", ".join(f"try_strptime(w, '{f}')" for _, f in _formats)}] AS d FROM written),
    votes AS (
        {" UNION ALL ".join(
            f"SELECT {i} AS place, '{name}' AS format, count(d[{i + 1}]) AS parsed,"
            f" count(d[{i + 1}]) FILTER (WHERE len(list_filter(d, lambda x: x IS NOT NULL)) = 1) AS alone,"
            f" count(d[{i + 1}]) FILTER (WHERE len(list_filter(d, lambda x: x <> d[{i + 1}])) > 0) AS ambiguous FROM read"
            for i, (name, _) in enumerate(_formats))})
    SELECT *, parsed > 0 AND row_number() OVER (ORDER BY parsed DESC, alone DESC, place) = 1 AS elected FROM votes"""
ORACLES["vocab_file_check"] = _sql(
    INDEXED,
    """SELECT reason, line FROM (
         SELECT 'malformed' AS reason, term || '-' || idx AS line FROM vocab WHERE idx % 50 = 7
         UNION ALL SELECT 'missing index', CAST(idx AS VARCHAR) FROM vocab
           WHERE idx % 50 IN (7, 13) AND idx < (SELECT max(idx) FROM vocab WHERE idx % 50 NOT IN (7, 13))
         UNION ALL SELECT unnest(['repeated index', 'repeated index', 'repeated term', 'repeated term']), term || ':' || idx
           FROM vocab WHERE idx % 50 = 21
         UNION ALL SELECT 'repeated index', term || mark || ':' || idx FROM vocab, (SELECT unnest(['', '!']) AS mark) WHERE idx % 50 = 33
         UNION ALL SELECT 'out of order', term || ':' || idx FROM vocab WHERE idx % 50 = 42
         UNION ALL SELECT 'out of order', b.term || ':' || b.idx FROM vocab a JOIN vocab b ON b.idx = a.idx + 1
           WHERE a.idx % 50 = 33 AND b.term <= a.term || '!')""",
)
ORACLES["vector_file_check"] = _sql(
    [*BODY, "body_counts"],
    """SELECT reason, line FROM (
         SELECT *, unnest(CASE doc_id % 40
             WHEN 3 THEN [('malformed', line || ';'), ('missing document', CAST(doc_id AS VARCHAR))]
             WHEN 8 THEN [('missing document', CAST(doc_id AS VARCHAR))]
             WHEN 14 THEN [('repeated document', line), ('repeated document', line)]
             WHEN 22 THEN [('unknown document', '#-' || line[2:]), ('missing document', CAST(doc_id AS VARCHAR))]
             WHEN 29 THEN [('unordered indexes', '#' || doc_id || ',7:1,5:2')]
             WHEN 35 THEN [('index too large', '#' || doc_id || ',999999999:1')] END) AS p, p[1] AS reason_, p[2] AS line_
         FROM (SELECT d.doc_id, '#' || d.doc_id || ',' || coalesce(string_agg(c.idx || ':' || c.tf, ',' ORDER BY c.idx), '') AS line
               FROM documents d LEFT JOIN body_counts c ON c.doc_id = d.doc_id GROUP BY d.doc_id)) x""",
).replace("SELECT reason, line FROM (\n         SELECT *, unnest", "SELECT p[1] AS reason, p[2] AS line FROM (\n         SELECT doc_id, unnest").replace(" AS p, p[1] AS reason_, p[2] AS line_", " AS p")

_stumps = ORACLES["dt_stump"].split("SELECT doc_id, label, CAST(p > 0.5", 1)
ORACLES["resumed_grid"] = _recursive(
    [*NEWTON, "body_raw", "variety", "values_seen", "splits", "gains", "stump"],
    "SELECT 'Numbers' AS scope, 'Logistic Regression' AS model, doc_id, label, CAST(margin > 0 AS INTEGER) AS prediction, fold"
    " FROM lr_scored UNION ALL SELECT 'Variety', 'Decision Tree', doc_id, label, CAST(p > 0.5 AS INTEGER), fold "
    + _stumps[1][_stumps[1].index("FROM (SELECT v.doc_id") :],
)
