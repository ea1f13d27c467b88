"""Features, cleaning and formats of single texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import clean, html, prompts, similarity, text
from corpusloom.functions.text import SPACE, SYMBOL
from corpusloom.operators.filters import few_shot_eligible
from corpusloom.operators.select import ranks_between
from corpusloom.queries import fixed
from corpusloom.queries.base import blank, chars, hits, lines, listed, query, quoted, table, trim, words
from corpusloom.sources.web import page_urls

_CODE = "coalesce(source_code, '')"


@query(f"select doc_id, {words('text')} as words, {chars('text')} as chars, {chars(trim('text'))} as trimmed, {blank('text')} as blank from documents")
def text_features(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.word_count("text").alias("words"), text.char_count("text").alias("chars"), text.trimmed_length("text").alias("trimmed"), text.is_blank("text").alias("blank"))


@query(f"""select row_id, len(x) as lines, len(list_filter(x, lambda l: {'not ' + blank('l')})) as filled_lines,
len(list_filter(x, lambda l: starts_with({trim('l')}, '//'))) as comment_lines,
len(list_filter(x, lambda l: not {blank('l')} and not starts_with({trim('l')}, '//'))) as code_lines
from (select row_id, {lines(_CODE)} as x from strategies)""")
def code_line_stats(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "strategies").select("row_id", *[c.alias(n) for n, c in text.line_stats("source_code").items()])


_FLAGS = {"has_version": "//@version", "has_strategy": "strategy(", "has_input": "input", "has_plot": "plot", "has_ta": "ta.", "has_alert": "alertcondition"}


@query("select row_id, " + ", ".join(f"coalesce(contains(source_code, '{t}'), false) as {n}" for n, t in _FLAGS.items()) + " from strategies")
def substring_flags(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "strategies").select("row_id", *[c.alias(n) for n, c in text.contains_flags("source_code", _FLAGS).items()])


@query(f"select row_id, array_to_string(list_filter({listed(fixed.CODE_FUNCTIONS)}, lambda v: contains({_CODE}, v)), ',') as found, {hits('source_code', fixed.CODE_FUNCTIONS)} as n from strategies")
def vocabulary_hits(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "strategies").select("row_id", F.array_join(text.term_hits("source_code", fixed.CODE_FUNCTIONS), ",").alias("found"), text.hit_count("source_code", fixed.CODE_FUNCTIONS).alias("n"))


def _n(t: str, term: str) -> str:
    return f"((length({t}) - length(replace({t}, '{term}', ''))) // {len(term)})"


@query(f"""select row_id, {_n(_CODE, '(')} = {_n(_CODE, ')')} and {_n(_CODE, '[')} = {_n(_CODE, ']')} and not ends_with({trim(_CODE)}, ',') as balanced,
list_reduce(list_prepend('', regexp_extract_all({_CODE}, '[()\\[\\]{{}}]')), lambda s, b: case
 when starts_with(s, 'x') then s when b in ('(', '[', '{{') then s || b
 when (b = ')' and ends_with(s, '(')) or (b = ']' and ends_with(s, '[')) or (b = '}}' and ends_with(s, '{{')) then left(s, length(s) - 1)
 else 'x' end) <> '' as fault from strategies""")
def bracket_checks(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "strategies").select("row_id", text.balanced("source_code").alias("balanced"), text.bracket_fault("source_code").alias("fault"))


_TERMS = {"equals": "=", "closes": "close", "averages": "ta.sma"}


@query("select row_id, " + ", ".join(f"{_n(_CODE, t)} as {n}" for n, t in _TERMS.items()) + " from strategies")
def occurrence_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "strategies").select("row_id", *[text.occurrences("source_code", t).alias(n) for n, t in _TERMS.items()])


_FENCE = f"(?:[A-Za-z]+[ \\t\\r]*\\n|{SPACE}*)"


def _blocks(t: str, head: str = _FENCE) -> str:
    return f"regexp_extract_all(coalesce({t}, ''), '(?si)```{head}(.*?)```', 1)"


@query(f"""select pair_id, {trim(f"coalesce({_blocks('output', f'(?:pine){SPACE}+')}[1], {_blocks('output')}[1], output)")} as code, len({_blocks('output')}) as blocks from script_pairs""")
def code_blocks(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "script_pairs").select("pair_id", text.code_or_text("output", "pine").alias("code"), F.size(text.code_blocks("output")).cast("long").alias("blocks"))


@query(f"select doc_id, coalesce(regexp_matches(text, '{fixed.FOREIGN}'), false) as is_foreign from documents")
def foreign_flags(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.is_foreign("text").alias("is_foreign"))


@query(f"""select state_id, coalesce(array_to_string(list_transform(relevant_symbols, lambda s: upper(s)), ','), '') as symbols,
regexp_extract(coalesce(array_to_string(relevant_symbols, ' '), ''), '{SYMBOL}') as first_symbol,
translate(coalesce(relevant_symbols[1], ''), '/:', '__') as file_name from processing_states""")
def symbol_texts(spark: SparkSession, d: str) -> DataFrame:
    s = F.col("relevant_symbols")
    return table(spark, d, "processing_states").select("state_id", F.coalesce(text.joined_upper(s), F.lit("")).alias("symbols"), text.first_symbol(F.array_join(s, " ")).alias("first_symbol"), text.file_safe(F.coalesce(F.get(s, F.lit(0)), F.lit(""))).alias("file_name"))


_IDS = lambda t: f"list_distinct(list_transform(list_filter(regexp_extract_all({t}, '[\\p{{L}}\\p{{N}}_]+'), lambda w: regexp_matches(w, '^[A-Za-z_][A-Za-z0-9_]*$') and length(w) > 2 and not (upper(w) = w and lower(w) <> w)), lambda w: lower(w)))"


@query(f"select row_id, array_to_string(list_sort({_IDS(_CODE)}), ',') as identifiers from strategies")
def identifier_sets(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "strategies").select("row_id", F.array_join(F.array_sort(text.identifiers("source_code")), ",").alias("identifiers"))


def _picked(term: str, k: int, width: int) -> str:
    return f"array_to_string(list_transform(list_filter({lines(_CODE)}, lambda l: contains(l, '{term}'))[1:{k}], lambda l: left({trim('l')}, {width})), chr(10))"


@query(f"select row_id, {_picked('//@version', 1, 100)} as version, {_picked('input', 3, 80)} as inputs, {_picked('strategy.entry', 2, 100)} as entries from strategies")
def picked_lines(spark: SparkSession, d: str) -> DataFrame:
    pick = lambda term, k, width: F.array_join(text.picked_lines("source_code", term, k, width), "\n")
    return table(spark, d, "strategies").select("row_id", pick("//@version", 1, 100).alias("version"), pick("input", 3, 80).alias("inputs"), pick("strategy.entry", 2, 100).alias("entries"))


@query("select row_id, coalesce(nullif(likes_count, 0), nullif(preview_likes_count, 0), 0) as likes, coalesce(nullif(name, ''), nullif(preview_title, '')) as title, nullif(regexp_extract(script_url, '/script/([^/]+)/', 1), '') as script, coalesce(try_cast(regexp_extract(replace(description, ',', ''), '([0-9]+)', 1) as bigint), 0) as first_number, left(description, 100) as head from strategies")
def coalesced_fields(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "strategies").select("row_id", text.first_nonzero("likes_count", "preview_likes_count").alias("likes"), text.first_filled("name", "preview_title").alias("title"), html.script_id("script_url").alias("script"), text.first_number("description").alias("first_number"), F.left("description", F.lit(100)).alias("head"))


@query("""select i::int as page, case when i = 1 then 'https://scripts.example/listing/?sort=top' else 'https://scripts.example/listing/page-' || i || '/?sort=top' end as url from range(1, 51) t(i)""")
def listing_urls(spark: SparkSession, d: str) -> DataFrame:
    return page_urls(spark, "https://scripts.example/listing/?sort=top", 1, 50, "dash")


@query()
def python_syntax(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "processing_states").select("state_id", text.python_parses("converted_code").alias("parses"))


@query(f"""select row_id, array_to_string(list_filter(x, lambda l: not regexp_matches(l, '{fixed.DRAWING_LINE}')), chr(10)) as cleaned,
coalesce(len(list_filter(x, lambda l: regexp_matches(l, '{fixed.DRAWING_LINE}'))), 0) as removed from (select row_id, {lines('source_code')} as x from strategies)""")
def drawing_removed(spark: SparkSession, d: str) -> DataFrame:
    out = clean.drawing_removed("source_code")
    return table(spark, d, "strategies").select("row_id", out["cleaned"].alias("cleaned"), out["removed"].alias("removed"))


@query(f"select row_id, {trim(f'''array_to_string(list_filter({lines('source_code')}, lambda l: not regexp_matches(l, '{fixed.PLOT_CALL}')), chr(10))''')} as stripped from strategies")
def plots_stripped(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "strategies").select("row_id", clean.plots_stripped("source_code").alias("stripped"))


@query(f"""select row_id, regexp_replace(array_to_string(list_filter(list_transform({lines('source_code')}, lambda l: regexp_replace(regexp_replace(l, '//[^\\n]*', '', 'g'), '/\\*[^\\n]*?\\*/', '', 'g')), lambda l: not {blank('l')}), chr(10)), '(?s)/\\*.*?\\*/', '', 'g') as code from strategies""")
def comments_stripped(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "strategies").select("row_id", clean.comments_stripped("source_code").alias("code"))


_COLLAPSED = trim(f"regexp_replace(text, '{SPACE}+', ' ', 'g')")


@query(f"select doc_id, {_COLLAPSED} as collapsed, length({_COLLAPSED}) as n, replace(text, '*', '') as plain from documents")
def spaces_collapsed(spark: SparkSession, d: str) -> DataFrame:
    c = clean.spaces_collapsed("text")
    return table(spark, d, "documents").select("doc_id", c.alias("collapsed"), F.length(c).cast("long").alias("n"), clean.emphasis_removed("text").alias("plain"))


_I, _O = "coalesce(input, '')", "coalesce(output, '')"
_INS = quoted(prompts.INSTRUCTION)


def _concat(*parts: str) -> str:
    return " || ".join(parts).replace("\\n", "' || chr(10) || '")


@query(f"""select pair_id,
{_concat(f"'### Instruction:\\n' || {_INS} || '\\n\\n### Description:\\n'", _I, "'\\n\\n### Code:\\n'", _O)} as instruction,
{_concat(f"'System: {prompts.SYSTEM}\\n\\nHuman: '", _I, "'\\n\\nAssistant: '", _O)} as conversation,
{_concat(f"'<|im_start|>system\\n{prompts.SYSTEM}<|im_end|>\\n<|im_start|>user\\n'", _I, "'<|im_end|>\\n<|im_start|>assistant\\n'", _O, "'<|im_end|>'")} as chatml,
{_concat(f"'{prompts.ALPACA}\\n\\n### Instruction:\\n{prompts.ALPACA_TASK}\\n\\n### Input:\\n'", _I, "'\\n\\n### Response:\\n'", _O)} as alpaca,
{_concat(_I, "'\\n\\n'", _O)} as simple,
{_concat(f"'{prompts.TRAINING}\\n\\n### Instruction:\\n'", _I, "'\\n\\n### Response:\\n'", _O)} as training from script_pairs""")
def prompt_formats(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "script_pairs").select("pair_id", *[prompts.formatter(n)("input", "output").alias(n) for n in prompts.FORMATS])


@query(f"""select pair_id, {_concat("'<think>\\n'", _I, "'\\n</think>\\n<answer>\\n'", _O, "'\\n</answer>'")} as thought,
case when {_O} like '%INSTRUCTION:%' and {_O} like '%OUTPUT:%' then 'marked' else {_O} end as plain from script_pairs""")
def thought_answers(spark: SparkSession, d: str) -> DataFrame:
    parts = prompts.instruction_output("output")
    return table(spark, d, "script_pairs").select("pair_id", prompts.thought_answer("input", "output").alias("thought"), F.when(parts["instruction"] != "", "marked").otherwise(parts["output"]).alias("plain"))


_EXAMPLES = "select *, row_number() over (order by coalesce(likes_count, 0) desc, pair_id) as n from script_pairs where length(input) > 50 and length(output) > 200"
_HEAD = "You are an expert TradingView Pine Script developer. Based on strategy descriptions, generate complete Pine Script code.\n\nHere are some examples:\n\n"
_ZERO = (
    "You are an expert TradingView Pine Script developer. Generate complete and functional Pine Script code for the following trading strategy:\n\nDescription: ",
    "\n\nPlease generate complete Pine Script v5 code that implements this strategy. Include all necessary components like strategy declaration, inputs, calculations, entry/exit logic, and plotting.\n\nPine Script Code:",
)
_NL = lambda t: quoted(t).replace("\n", "' || chr(10) || '")


@query(f"""with r as ({_EXAMPLES}), x as (select string_agg('Example ' || n || ':' || chr(10) || 'Description: ' || left(input, 200) || {_NL(chr(10).join(["...", "", "Pine Script Code:", ""]))} || left(output, 500) || {_NL(chr(10).join(["...", "", "---", "", ""]))}, '' order by n) as shown from r where n <= 3)
select pair_id, {_NL(_HEAD)} || shown || {_NL("Now generate Pine Script code for this strategy:" + chr(10) * 2 + "Description: ")} || coalesce(input, '') || {_NL(chr(10) * 2 + "Pine Script Code:")} as few_shot, {_NL(_ZERO[0])} || coalesce(input, '') || {_NL(_ZERO[1])} as zero_shot from script_pairs, x""")
def generation_prompts(spark: SparkSession, d: str) -> DataFrame:
    """For every pair's description a prompt after three examples and one without any."""
    rows = table(spark, d, "script_pairs")
    best = ranks_between(rows.where(few_shot_eligible("input", "output", None)), F.coalesce("likes_count", F.lit(0)), "pair_id", 1, 3)
    shown = prompts.few_shot(best, "rank", 3, prompts.shown_example("rank", "input", "output"))
    return rows.select("pair_id", prompts.generation_prompt("input", shown).alias("few_shot"), prompts.generation_prompt("input").alias("zero_shot"))


def _outline(head: str, term: str, k: int, row: str) -> str:
    found = f"list_filter({lines('output')}, lambda l: contains(l, '{term}'))"
    return f"case when len({found}) > 0 then {_NL(head)} || array_to_string(list_transform({found}[1:{k}], lambda l: {row}), '') else '' end"


_BAR = "=" * 50
_ROW = f"'  ' || left({trim('l')}, 80) || '...' || chr(10)"


@query(f"""select pair_id, '{_BAR}' || chr(10) || 'EXAMPLE ' || n || chr(10) || '{_BAR}' || chr(10) || 'Strategy: ' || coalesce(name, 'Unknown') || chr(10) || 'Likes: ' || coalesce(likes_count, 0) || {_NL(chr(10) * 2 + "Description:" + chr(10))} || left(input, 400) || '...' || chr(10) || chr(10)
|| coalesce('Version: ' || list_filter({lines('output')}, lambda l: starts_with(l, '//@version='))[1] || chr(10), '') || {_outline("Strategy Declaration: ", "strategy(", 1, "left(l, 100) || '...' || chr(10)")} || {_outline("Input Examples:" + chr(10), "input.", 3, _ROW)} || {_outline("Entry Logic:" + chr(10), "strategy.entry", 2, _ROW)} || chr(10) as shown from ({_EXAMPLES}) where n <= 200""")
def outlined_examples(spark: SparkSession, d: str) -> DataFrame:
    """The telling lines of the 200 best pairs, as examples of a prompt."""
    best = ranks_between(table(spark, d, "script_pairs").where(few_shot_eligible("input", "output", None)), F.coalesce("likes_count", F.lit(0)), "pair_id", 1, 200)
    return best.select("pair_id", prompts.outlined_example("rank", "name", "likes_count", "input", "output").alias("shown"))


def _thought(steps: Sequence[str]) -> str:
    return f"{_NL('<think>' + chr(10) + '1. **Strategy Analysis**: ')} || {_I} || {_NL(''.join(chr(10) * 2 + s for s in steps) + chr(10) + '</think>' + chr(10) + '<answer>' + chr(10))} || {_O} || {_NL(chr(10) + '</answer>')}"


_STEPS = (
    "2. **Implementation Approach**: I need to break down this strategy into its core components and implement each part using appropriate Pine Script functions.",
    "3. **Technical Requirements**: Identify the necessary technical indicators, parameters, and conditional logic required for this strategy.",
    "4. **Code Structure**: Plan the implementation by determining the sequence of operations and proper Pine Script syntax to achieve the desired functionality.",
)
_RESTEPS = (
    "2. **Implementation Requirements**: Based on the strategy description, I need to implement the core logic using appropriate Pine Script functions and syntax.",
    "3. **Code Structure Planning**: I'll analyze the required components and translate them into Pine Script syntax, considering proper variable naming, function usage, and logic flow.",
    "4. **Pine Script Translation**: Converting the conceptual strategy requirements into executable Pine Script code with appropriate technical indicators and conditional logic.",
)
_RESPONSE = f"case pair_id % 3 when 0 then 'INSTRUCTION: do it OUTPUT: <think>t</think><answer>' || {_O} || '</answer>' when 1 then 'INSTRUCTION: do that OUTPUT: ' || {_O} else {_O} end"


@query(f"""select pair_id, {_thought(_STEPS)} as template, case pair_id % 3 when 0 then 'do it' when 1 then 'do that' end as instruction,
case when pair_id % 3 = 0 then {trim(f"'<think>t</think><answer>' || {_O} || '</answer>'")} else {_thought(_RESTEPS)} end as output from script_pairs""")
def reasoned_answers(spark: SparkSession, d: str) -> DataFrame:
    """Reasoned answers by template, and read from responses of three forms: marked and tagged, marked, neither."""
    rows = table(spark, d, "script_pairs").withColumn("response", F.expr(_RESPONSE))
    pair = prompts.reasoned_pair("response", "input", "output")
    return rows.select("pair_id", prompts.reasoned_answer("input", "output").alias("template"), F.when(F.expr("pair_id % 3 < 2"), pair["instruction"]).alias("instruction"), pair["output"].alias("output"))


def _escaped(c: str) -> Column:
    return F.replace(F.replace(F.coalesce(F.col(c), F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def _card(d: DataFrame) -> Column:
    """A listing's card, made of a crawl's preview fields."""
    return F.concat(
        F.lit('<article class="card-x big"><h3><a href="'), F.coalesce("script_url", F.lit("")), F.lit('">'), _escaped("preview_title"), F.lit('</a></h3><a href="/script/other/">u</a><a class="x-author" href="'), F.coalesce("preview_author_url", F.lit("")), F.lit('">by '), _escaped("preview_author"),
        F.lit('</a><time datetime="'), F.coalesce("preview_created_at", F.lit("")), F.lit('"> some day </time><button class="boost-1">'), F.format_number(F.coalesce("preview_likes_count", F.lit(0)), 0), F.lit(' boosts</button><a class="comment-button">'), F.coalesce(F.col("preview_comments_count").cast("string"), F.lit("none")), F.lit("</a></article>"),
    )


def _page(spark: SparkSession, d: str) -> DataFrame:
    """Script pages made of the scripts' fields as a browser would show them: the code stands in editor tokens, a code element, a
    script or plain text by turns, the likes in a counter of digits or as text."""
    rows = table(spark, d, "strategies").withColumn("turn", F.expr("row_id % 4")).withColumn("code", F.replace(F.coalesce("source_code", F.lit("")), F.lit("\r"), F.lit("")))
    likes = F.coalesce("likes_count", F.lit(0)).cast("string")
    tokens = F.array_join(F.transform(F.split(_escaped("code"), "\n", -1), lambda x: F.concat(F.lit('<div class="view-line"><span><span class="mtk1">'), x, F.lit('</span><span class="mtk2"></span></span></div>'))), "")
    place = (
        F.when(F.col("turn") == 0, F.concat(F.lit('<div class="code-box">'), tokens, F.lit("</div>")))
        .when(F.col("turn") == 1, F.concat(F.lit('<div class="source-code"><pre>'), _escaped("code"), F.lit("</pre></div>")))
        .when(F.col("turn") == 2, F.concat(F.lit('<script>var x = {"source": '), F.expr("substring(to_json(named_struct('a', code)), 6, length(to_json(named_struct('a', code))) - 6)"), F.lit("}</script>")))
        .otherwise(F.lit(""))
    )
    digits = F.array_join(F.transform(F.regexp_extract_all(likes, F.lit("[0-9]"), F.lit(0)), lambda x: F.concat(F.lit('<span class="digitGrid-1"><span class="digit-2">'), x, F.lit("</span></span>"))), "")
    counter = F.when(F.col("turn") < 2, F.concat(F.lit('<button aria-pressed="false"><span class="container-3">'), digits, F.lit("</span></button>"))).otherwise(F.concat(F.lit('<i class="boost-count">'), F.format_number(F.coalesce("likes_count", F.lit(0)), 0), F.lit("</i>")))
    chart = F.when(F.col("turn") == 0, F.lit("")).otherwise(F.concat(F.lit('<a href="/chart/'), F.col("row_id").cast("string"), F.lit('/">chart</a>')))
    symbol = F.when(F.col("turn") == 1, F.concat(F.lit('<meta name="symbol" content="'), _escaped("symbol"), F.lit('">'))).otherwise(F.concat(F.lit('<b class="symbol-name">'), _escaped("symbol"), F.lit("</b>")))
    user = F.concat(F.lit('<a href="/u/'), F.col("row_id").cast("string"), F.lit('/"><span class="usernameOutline-1"><span class="username-2">'), _escaped("author"), F.lit("</span></span></a>"), F.when(F.col("turn") == 2, '<i class="badge-pro"></i>').otherwise(""))
    page = F.concat(F.lit("<html><head>"), symbol, F.lit("</head><body>"), _card(rows), F.lit("<h1>"), _escaped("name"), F.lit('</h1><time datetime="'), F.coalesce("created_at", F.lit("")), F.lit('"></time>'), user, counter, chart, F.lit('<div class="description">'), _escaped("description"), F.lit("</div>"), place, F.lit("</body></html>"))
    return rows.select("row_id", "script_url", page.alias("html"))


_SITE = "https://scripts.example/listing/"
_JOINED = lambda c: f"case when starts_with({c}, 'http') then {c} when starts_with({c}, '/') then 'https://scripts.example' || {c} else '{_SITE}' || {c} end"


@query(f"""select row_id, {trim("coalesce(name, '')")} as name, {trim("coalesce(description, '')")} as description, coalesce(nullif(preview_created_at, ''), 'some day') as created_at, {trim("coalesce(symbol, '')")} as symbol, nullif({trim("coalesce(author, '')")}, '') as username,
case when coalesce({trim("author")}, '') <> '' then 'https://scripts.example/u/' || row_id || '/' end as profile_url, case when coalesce({trim("author")}, '') <> '' then row_id % 4 = 2 end as pro_plan, coalesce(likes_count, 0)::bigint as likes_count,
case when row_id % 4 = 0 then script_url else 'https://scripts.example/chart/' || row_id || '/' end as chart_url from strategies""")
def html_records(spark: SparkSession, d: str) -> DataFrame:
    rows = _page(spark, d).withColumn("r", html.script_record("html", F.coalesce("script_url", F.lit(""))))
    text_ = lambda c: F.coalesce(F.col(f"r.{c}"), F.lit("")).alias(c)
    return rows.select("row_id", text_("name"), text_("description"), text_("created_at"), text_("symbol"), "r.username", "r.profile_url", "r.pro_plan", "r.likes_count", "r.chart_url")


_CLEANED = trim("replace(coalesce(source_code, ''), chr(13), '')")
_MARKED = f"({' or '.join(f'contains({_CLEANED}, {quoted(m)})' for m in ('@version', 'indicator', 'strategy'))})"


@query(f"select row_id, {_CLEANED} as code from strategies where row_id % 4 < 3 and {_MARKED}")
def html_code(spark: SparkSession, d: str) -> DataFrame:
    """The code of pages that hold it in editor tokens, a code element or a script."""
    rows = _page(spark, d).where(F.expr("row_id % 4 < 3")).select("row_id", text.trimmed(html.script_record("html")["source_code"]).alias("code"))
    marked = table(spark, d, "strategies").where(text.any_of("source_code", html.CODE_MARKS)).select("row_id")
    return rows.join(marked, "row_id", "left_semi")


@query(f"""select row_id, {_JOINED("coalesce(script_url, '')")} as script_url, nullif({trim("coalesce(preview_title, '')")}, '') as preview_title, case when {blank('preview_author')} then 'by' else {trim("replace('by ' || preview_author, 'by ', '')")} end as preview_author,
case when coalesce(preview_author_url, '') <> '' then {_JOINED("preview_author_url")} end as preview_author_url, coalesce(preview_created_at, '') as preview_created_at, 'some day' as preview_created_display,
coalesce(preview_likes_count, 0)::bigint as preview_likes_count, coalesce(preview_comments_count, 0)::bigint as preview_comments_count from strategies where regexp_matches(script_url, '/script/[^/]+/')""")
def html_cards(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "strategies").where(F.col("script_url").rlike("/script/[^/]+/"))
    cards = rows.select("row_id", html.preview_cards(_card(rows), F.lit(_SITE)).alias("cards"))
    return cards.select("row_id", F.inline("cards"))


@query(f"select row_id, {trim("coalesce(name, '')")} as title, {_JOINED("coalesce(script_url, '')")} as url, {_JOINED("case when regexp_matches(script_url, '/script/[^/]+/') then script_url else '/script/other/' end")} as link from strategies")
def html_links(spark: SparkSession, d: str) -> DataFrame:
    join = lambda c: html.joined_url(F.lit(_SITE), c)
    return _page(spark, d).select("row_id", html.select_text("html", ".missing", "h1").alias("title"), join(html.select_attribute("html", "href", "article a")).alias("url"), join(F.get(html.script_links("html"), F.lit(0))).alias("link"))


def _crawls(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of successive crawls of a script."""
    from pyspark.sql import Window

    w = Window.partitionBy("id").orderBy("row_id")
    rows = table(spark, d, "strategies").select("row_id", "id", "source_code").where("id is not null")
    return rows.withColumn("before", F.lag("source_code").over(w)).withColumn("n", F.row_number().over(w)).where("n > 1").select("row_id", F.col("before").alias("a"), F.col("source_code").alias("b"))


def _bare(t: str) -> str:
    return trim(rf"regexp_replace(regexp_replace(regexp_replace({t}, '//[^\n]*', '', 'g'), '(?s)/\*.*?\*/', '', 'g'), '{SPACE}+', ' ', 'g')")


_KW = lambda t: "list_distinct(flatten([" + ", ".join(f"regexp_extract_all({t}, '(?i){k}')" for k in fixed.SHARED_KEYWORDS) + "]))"
_JAC = lambda x, y: f"case when len(list_distinct(list_concat({x}, {y}))) = 0 then 0.0::double else len(list_intersect({x}, {y}))::double / len(list_distinct(list_concat({x}, {y}))) end"
_CRAWLS = "select row_id, lag(source_code) over w as a, source_code as b, row_number() over w as n from strategies where id is not null window w as (partition by id order by row_id)"
_GRAMS = lambda t: "flatten([" + ", ".join(f"list_transform(range(1, length({t}) - {n} + 2), lambda i: substring({t}, i, {n}))" for n in (1, 2, 3)) + "])"
_PARTS = f"""with p as (select row_id, coalesce({_bare('a')}, '') as a, coalesce({_bare('b')}, '') as b from ({_CRAWLS}) where n > 1),
g as (select row_id, gram, sum(1 - side) as x, sum(side) as y from (select row_id, unnest({_GRAMS('lower(a)')}) as gram, 0 as side from p union all select row_id, unnest({_GRAMS('lower(b)')}), 1 from p) group by 1, 2),
c as (select row_id, case when sum(x) > 0 and sum(y) > 0 then sum(x * y * w * w) / sqrt(sum(x * x * w * w) * sum(y * y * w * w)) else 0.0 end as text from (select *, case when x > 0 and y > 0 then 1.0::double else ln(1.5::double) + 1 end as w from g) group by 1),
s as (select p.row_id, coalesce(c.text, 0.0) as text, (a = b)::int::double as structure, {_JAC(_KW('a'), _KW('b'))} as keywords, {_JAC(_IDS('a'), _IDS('b'))} as identifiers, 1 - abs(length(a) - length(b))::double / greatest(length(a), length(b), 1) as len from p left join c on c.row_id = p.row_id)"""


@query(f"""{_PARTS} select row_id, round(text, 6) as text, structure, round(keywords, 6) as keywords, round(identifiers, 6) as identifiers, round(len, 6) as length,
round(text * 0.3::double + structure * 0.25::double + keywords * 0.25::double + identifiers * 0.15::double + len * 0.05::double, 6) as overall,
case when greatest(text, structure) > 0.6 then 'High' when greatest(text, structure) > 0.3 then 'Medium' else 'Low' end as confidence from s""")
def pair_similarity(spark: SparkSession, d: str) -> DataFrame:
    s = similarity.code_similarities(_crawls(spark, d), "row_id", "a", "b")
    rounded = [F.round(n, 6).alias(n) for n in ("text", "keywords", "identifiers", "length", "overall")]
    return s.select("row_id", "structure", *rounded, similarity.similarity_confidence("text", "structure").alias("confidence"))


@query(f"{_PARTS} select row_id, round(text, 6) as cosine, case when text > 0.7 then 'High' when text > 0.4 then 'Medium' else 'Low' end as level from s")
def gram_similarity(spark: SparkSession, d: str) -> DataFrame:
    p = _crawls(spark, d).select("row_id", clean.comparable_code("a").alias("a"), clean.comparable_code("b").alias("b"))
    cosine = similarity.gram_cosine(p, "row_id", "a", "b")
    return cosine.select("row_id", F.round("cosine", 6).alias("cosine"), similarity.similarity_level("cosine").alias("level"))


@query()
def sequence_ratios(spark: SparkSession, d: str) -> DataFrame:
    p = _crawls(spark, d)
    return p.select("row_id", F.round(similarity.sequence_ratio(clean.comparable_line("a"), clean.comparable_line("b")), 6).alias("ratio"), F.length(similarity.unified_diff("a", "b")).alias("diff_chars"))


@query(f"""with p as (from ({_CRAWLS}) where n > 1), s as (select row_id, {_IDS("coalesce(a, '')")} as x, {_IDS("coalesce(b, '')")} as y from p)
select row_id, array_to_string(list_sort(list_filter(x, lambda v: not list_contains(y, v)))[1:10], ',') as only_a, array_to_string(list_sort(list_filter(y, lambda v: not list_contains(x, v)))[1:10], ',') as only_b from s""")
def set_differences(spark: SparkSession, d: str) -> DataFrame:
    a, b = similarity.set_differences(text.identifiers("a"), text.identifiers("b"))
    return _crawls(spark, d).select("row_id", F.array_join(a, ",").alias("only_a"), F.array_join(b, ",").alias("only_b"))

