"""Filters, classification, deduplication, scores, statistics, selection, mixing and pipelines over the project's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import clean, prompts, score, text
from corpusloom.functions.text import FILLED, SPACE
from corpusloom.operators import aggregate, classify, dedup, filters, mixing, nested, select
from corpusloom.plans import models, pipelines
from corpusloom.queries import fixed
from corpusloom.queries.base import any_hit, blank, capped, chars, hits, lines, listed, points, query, table, trim, words
from corpusloom.sources.files import column_profile
from corpusloom.sources.web import capped_per_page, listing_plan, merged_records

_CODE, _DESC, _I, _O = "coalesce(source_code, '')", "coalesce(description, '')", "coalesce(input, '')", "coalesce(output, '')"
_LIKES = "coalesce(nullif(likes_count, 0), nullif(preview_likes_count, 0), 0)"


def likes() -> Column:
    return text.first_nonzero("likes_count", "preview_likes_count")


# Filters.

_T = [("low_likes", "coalesce(likes_count, 0) <= 10"), ("few_words", f"{words('description')} <= 20"), ("few_chars", f"{chars('description')} <= 100")]


@query("select row_id, array_to_string(list_filter([" + ", ".join(f"case when {c} then '{n}' end" for n, c in _T) + "], lambda x: x is not null), ', ') as reasons from strategies")
def threshold_filter(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "strategies").select("row_id", filters.all_reasons(filters.threshold_checks("likes_count", "description")).alias("reasons"))


_REASON = f"""case when coalesce(likes_count, 0) < 100 then 'low_likes' when {blank('description')} or {blank('source_code')} then 'empty'
when {chars(trim('description'))} < 30 then 'short_description' when {chars(trim('source_code'))} < 50 then 'short_code' end"""


@query(f"select coalesce(reason, 'kept') as reason, count(*) as n, round(count(*) * 100.0::double / sum(count(*)) over (), 4) as percent from (select {_REASON} as reason from strategies) group by 1")
def script_filter_reasons(spark: SparkSession, d: str) -> DataFrame:
    rows = filters.with_reason(table(spark, d, "strategies"), filters.script_checks("likes_count", "description", "source_code"))
    return aggregate.histogram(rows, "reason", F.coalesce("reason", F.lit("kept")))


_CUT = trim(r"regexp_replace(l, '(?://|#)[^\n]*', '', 'g')")
_BARE = f"array_to_string(list_filter(list_transform({lines('output')}, lambda l: {_CUT}), lambda l: l <> ''), chr(10))"
_LOWO = f"lower({_O})"
_VALID = f"coalesce({chars(trim('output'))} >= 10 and not {any_hit(_LOWO, fixed.NOTES)} and {chars(_BARE)} >= 10 and {any_hit(_BARE, fixed.CODE_SIGNS)}, false)"
_SEG = f"case when {blank('input')} or {blank('output')} then 'empty' when not {_VALID} then 'invalid_code' when {chars(trim('input'))} < 20 then 'short_description' end"


@query(f"select segment_id, {_SEG} as reason from segments")
def segment_filter(spark: SparkSession, d: str) -> DataFrame:
    return filters.with_reason(table(spark, d, "segments"), filters.segment_checks("input", "output")).select("segment_id", "reason")


_MBARE = trim(rf"regexp_replace(regexp_replace(regexp_replace(regexp_replace(output, '//[^\n]*', '', 'g'), '(?s)/\*.*?\*/', '', 'g'), '#[^\n]*', '', 'g'), '{SPACE}+', ' ', 'g')")
_SHAPES = " or ".join(f"regexp_matches({_MBARE}, '{p}')" for p in fixed.CODE_SHAPES)


@query(f"select segment_id, coalesce({chars(trim('output'))} >= 20 and ({_SHAPES}) and not regexp_matches(output, '{fixed.NOTE_ONLY}'), false) as meaningful from segments")
def meaningful_code(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "segments").select("segment_id", filters.meaningful_code("output").alias("meaningful"))


@query(f"select row_id from strategies where contains({_CODE}, 'strategy(') and (contains({_CODE}, 'strategy.entry') or contains({_CODE}, 'strategy.order'))")
def trading_strategies(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "strategies").where(filters.is_strategy("source_code")).select("row_id")


@query(f"select row_id, {chars('description')} > 100 and {chars('source_code')} > 300 and {_LIKES} > 50 as strict, {chars('description')} > 50 and {chars('source_code')} > 200 as loose from strategies")
def few_shot_pool(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "strategies").select("row_id", filters.few_shot_eligible("description", "source_code", likes(), 100, 300, 50).alias("strict"), filters.few_shot_eligible("description", "source_code", None).alias("loose"))


@query(f"select pair_id, n from (select pair_id, {words('input')} + {words('output')} as n from script_pairs) where n <= 200")
def length_filter(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "script_pairs").select("pair_id", (text.word_count("input") + text.word_count("output")).alias("n")).where("n <= 200")


@query("select row_id, id from strategies where row_id >= 1000 or not exists (select 1 from script_pairs p where p.script_id = strategies.id)")
def resumed_rows(spark: SparkSession, d: str) -> DataFrame:
    done = table(spark, d, "script_pairs").select(F.col("script_id").alias("id"))
    return filters.not_done(table(spark, d, "strategies"), "id", done, "row_id", 1000).select("row_id", "id")


# Classification.

_KIND = f"case when regexp_matches({_CODE}, '{fixed.STRATEGY}') then 'strategy' when regexp_matches({_CODE}, '{fixed.INDICATOR}') then 'indicator' when regexp_matches({_CODE}, '{fixed.ORDER_CALL}') then 'strategy' when regexp_matches({_CODE}, '{fixed.PLOTS}') then 'indicator' else 'unknown' end"


@query(f"select row_id, {_KIND} as kind, regexp_matches({_CODE}, '{fixed.PLOTS}') as has_plots, regexp_matches({_CODE}, '{fixed.ORDERS}') as has_orders, {words('description')} as description_words from strategies")
def script_kinds(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "strategies").select("row_id", *[c.alias(n) for n, c in classify.script_traits("source_code", "description").items()])


@query(f"select row_id, case {' '.join(f'when {any_hit(f'lower({_DESC})', t)} then {chr(39)}{n}{chr(39)}' for n, t in fixed.THEMES)} else 'standard' end as theme from strategies")
def first_themes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "strategies").select("row_id", classify.first_theme("description").alias("theme"))


_BUCKETS = " union all ".join(f"select row_id, '{n}' as theme, {_LIKES} as likes from strategies where {any_hit(f'lower({_DESC})', t)}" for n, t in fixed.BUCKETS)


@query(f"select theme, count(*) as n from ({_BUCKETS}) group by 1")
def theme_buckets(spark: SparkSession, d: str) -> DataFrame:
    return classify.by_theme(table(spark, d, "strategies"), "description").groupBy("theme").agg(F.count("*").alias("n"))


@query("select pair_id, case when quality_score * 10 >= 80 then 'excellent' when quality_score * 10 >= 60 then 'good' when quality_score * 10 >= 40 then 'fair' else 'low' end as band from script_pairs")
def rate_bands(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "script_pairs").select("pair_id", classify.acceptance_band(F.col("quality_score") * 10).alias("band"))


_SAYS = lambda *terms: any_hit(f"lower({_DESC})", terms)
_INSTRUCTION = f"""'Implement a Pine Script code for ' || case when {_SAYS('sma', 'moving average')} then case when {_SAYS('threshold')} then 'SMA-based strategy with dynamic thresholds.' else 'moving average crossover strategy.' end
when {_SAYS('rsi')} then 'RSI-based trading signals.' when {_SAYS('input')} and {_SAYS('parameter')} then 'configurable strategy parameters.' when {_SAYS('threshold')} and {_SAYS('entry')} then 'threshold-based entry and exit signals.'
when {_SAYS('signal', 'buy', 'sell')} then 'trading signal generation.' else 'the described trading strategy.' end"""


@query(f"select row_id, {_INSTRUCTION} as template from strategies")
def instruction_templates(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "strategies").select("row_id", classify.instruction_for("description").alias("template"))


# Deduplication.


@query("select distinct text, lang, source from documents")
def distinct_documents(spark: SparkSession, d: str) -> DataFrame:
    return dedup.distinct_rows(table(spark, d, "documents").select("text", "lang", "source"))


_KEY = f"lower({trim(f'''regexp_replace(output, '{SPACE}+', ' ', 'g')''')})"


@query(f"select segment_id, source_id, segment_key, input, output from (select *, row_number() over (partition by {_KEY} order by {chars('input')} desc, segment_id) as n from segments) where n = 1")
def longest_kept(spark: SparkSession, d: str) -> DataFrame:
    return dedup.keep_longest(table(spark, d, "segments"), "output", "input", "segment_id").select("segment_id", "source_id", "segment_key", "input", "output")


@query("select id, max(row_id) as row_id, arg_max(name, row_id) as name from (select id, row_id, coalesce(name, '') as name from strategies where id is not null) group by id")
def latest_crawls(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "strategies").where("id is not null").select("id", "row_id", F.coalesce("name", F.lit("")).alias("name"))
    return dedup.latest_by(rows, "id", "row_id")


@query()
def dissimilar_parts(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "segments").select("segment_id", "source_id", "output")
    return dedup.keep_dissimilar(rows, "source_id", "segment_id", "output").select("segment_id", "source_id")


# Nested data.


@query("""select source_id, key, input, output from (select coalesce(source_id, 'unknown') as source_id, segment_key as key, input, output,
row_number() over (partition by coalesce(source_id, 'unknown'), segment_key order by coalesce(length(output), -1) desc, coalesce(output, '') desc, coalesce(input, '') desc) as n
from segments where segment_key is not null) where n = 1 and input is not null and output is not null""")
def packed_unpacked(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "segments").withColumn("source_id", F.coalesce("source_id", F.lit("unknown")))
    return nested.unpacked(nested.packed(rows, "source_id", "segment_key", "input", "output"), "source_id", "components")


@query("select event_id, try_cast(json_extract_string(props, '$.k') as bigint) as k, regexp_extract(props, '\\{[^{}]+\\}') as flat from events")
def json_properties(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", nested.parsed("props", "k bigint")["k"].alias("k"), nested.flat_json_in("props").alias("flat"))


@query()
def balanced_json(spark: SparkSession, d: str) -> DataFrame:
    wrapped = F.concat(F.lit("Sure, here it is: "), F.col("props"), F.lit(" and {more"))
    return table(spark, d, "events").select("event_id", nested.balanced_json_in(wrapped).alias("json"))


@query("select s.row_id, coalesce(p.input, s.description) as description, s.name from strategies s left join (select script_id, min(input) as input from script_pairs group by 1) p on p.script_id = s.id")
def overlaid_descriptions(spark: SparkSession, d: str) -> DataFrame:
    over = table(spark, d, "script_pairs").groupBy(F.col("script_id").alias("id")).agg(F.min("input").alias("description"))
    return nested.overlaid(table(spark, d, "strategies").select("row_id", "id", "description", "name"), over, "id", ["description"]).select("row_id", "description", "name")


@query("select s.row_id, coalesce(p.name, s.name) as name, coalesce(p.likes_count, s.likes_count) as likes_count, p.n from strategies s left join (select script_id as id, max(name) as name, max(likes_count) as likes_count, count(*) as n from script_pairs group by 1) p on p.id = s.id")
def merged_crawl(spark: SparkSession, d: str) -> DataFrame:
    details = table(spark, d, "script_pairs").groupBy(F.col("script_id").alias("id")).agg(F.max("name").alias("name"), F.max("likes_count").alias("likes_count"), F.count("*").alias("n"))
    return merged_records(table(spark, d, "strategies").select("row_id", "id", "name", "likes_count"), details, "id").select("row_id", "name", "likes_count", "n")


@query("select 'scripts' as data_source, 'user' as role, 'Write: ' || input as content, 'code' as ability, output as ground_truth, script_id, name, round(coalesce(quality_score, 0) / 10, 6) as reward from script_pairs where input is not null and output is not null")
def rl_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "script_pairs").withColumn("made", F.col("made_at").cast("string"))
    out = nested.rl_rows(rows, "script_id", "name", F.concat(F.lit("Write: "), F.col("input")), F.col("output"), "made", F.coalesce("quality_score", F.lit(0.0)) / 10)
    return out.select("data_source", F.col("prompt")[0]["role"].alias("role"), F.col("prompt")[0]["content"].alias("content"), "ability", F.col("reward_model.ground_truth").alias("ground_truth"), F.col("extra_info.strategy_id").alias("script_id"), F.col("extra_info.strategy_name").alias("name"), F.round("extra_info.reward_score", 6).alias("reward"))


# Scores.

_LD, _LC = f"lower({_I})", f"lower({_O})"
_BOTH = f"({_LD} || ' ' || {_LC})"
_SEGMENT = " + ".join([
    "3.0::double", points(f"{chars('input')} > 50", 1), points(f"{chars('input')} > 100", 0.5), points(f"{chars('output')} > 20", 1), points(f"{chars('output')} > 50", 0.5),
    capped(hits(_BOTH, fixed.SEGMENT_TERMS), 0.4, 2.5), capped(hits(_O, fixed.SEGMENT_CODE), 0.2, 1.5), capped(hits(_LC, fixed.SEGMENT_NAMES), 0.3, 1.0),
    points(f"contains({_LC}, 'note:') or starts_with({trim(_O)}, 'note')", -2), f"{hits(_LD, fixed.GENERIC)} * -0.3::double", capped(hits(_LD, fixed.SPECIFIC), 0.2, 1.0),
])


@query(f"select segment_id, round(greatest(1.0::double, least(10.0::double, {_SEGMENT})), 6) as score from segments")
def segment_scores(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "segments").select("segment_id", F.round(score.segment_score("input", "output"), 6).alias("score"))


def _n(t: str, term: str) -> str:
    return f"((length({t}) - length(replace({t}, '{term}', ''))) // {len(term)})"


def _balanced(c: str) -> str:
    return f"({_n(c, '(')} = {_n(c, ')')} and {_n(c, '[')} = {_n(c, ']')} and not ends_with({trim(c)}, ','))"


def _quality(c: str) -> str:
    return "least(10.0::double, " + " + ".join([
        points(f"contains({c}, '//@version=')", 1), points(any_hit(c, ("strategy(", "indicator(")), 2), points(f"contains({c}, 'input.')", 1), points(f"contains({c}, 'ta.')", 1.5),
        points(any_hit(c, ("strategy.entry", "strategy.close")), 2), points(f"contains({c}, 'plot(')", 1), points(f"{hits(c, fixed.CODE_FUNCTIONS)} >= 3", 1), points(_balanced(c), 0.5),
    ]) + ")"


_STRATEGY = " + ".join([
    points(f"contains({_CODE}, '//@version=')", 1), points(f"contains({_CODE}, 'strategy(')", 2), points(f"contains({_CODE}, 'input.')", 1), points(any_hit(_CODE, ("ta.", "math.", "array.")), 1.5),
    points(f"contains({_CODE}, 'strategy.entry')", 2), points(any_hit(_CODE, ("strategy.exit", "strategy.close")), 1.5), points(any_hit(_CODE, ("plot(", "plotshape(")), 1), points(f"{hits(_CODE, fixed.STRATEGY_FUNCTIONS)} >= 5", 1),
])


@query(f"select row_id, least(10.0::double, {_STRATEGY}) as score from strategies")
def strategy_quality(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "strategies").select("row_id", score.strategy_quality("source_code").alias("score"))


@query(f"select row_id, {_quality(_CODE)} as score from strategies")
def code_quality(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "strategies").select("row_id", score.code_quality("source_code").alias("score"))


def _length(t: str) -> str:
    n = f"({chars(t)})::double"
    return f"(case when {n} < 50 then 0.1::double when {n} > 2000 then 0.3::double when {n} >= 200 and {n} <= 800 then 1.0::double when {n} < 200 then 0.1::double + 0.9::double * ({n} - 50) / 150 else 0.3::double + 0.7::double * (2000 - {n}) / 1200 end)"


def _relevance(t: str, vocabulary: tuple[str, ...] = fixed.RELEVANT) -> str:
    total = " + ".join(_n(t, k) for k in vocabulary)
    return f"(0.7::double * least({hits(t, tuple(dict.fromkeys(vocabulary)))} / 20.0::double, 1.0::double) + 0.3::double * least(({total}) / 50.0::double, 1.0::double))"


@query(f"select doc_id, round({_length('text')}, 12) as length_score, round({_relevance('lower(coalesce(text, chr(32)))')}, 12) as relevance from documents")
def length_and_relevance(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.round(score.length_score("text"), 12).alias("length_score"), F.round(score.keyword_relevance("text"), 12).alias("relevance"))


def _groups(t: str) -> str:
    met = "(" + " + ".join(f"{any_hit(t, g)}::int" for g in fixed.GROUPS) + ")"
    return f"({met} * 0.2::double + {points(f'{met} >= 4', 0.2)})"


def _technical(t: str, raw: str) -> str:
    return f"({capped(hits(t, fixed.TECHNICAL), 0.05, 0.4)} + {points(f'regexp_matches({raw}, {chr(39)}{fixed.FORMULA}{chr(39)})', 0.2)} + {capped(hits(t, fixed.FINANCE), 0.05, 0.2)})"


def _novelty(t: str) -> str:
    return f"({capped(hits(t, fixed.NEW), 0.1, 0.3)} + {points(any_hit(t, ('combine', 'hybrid')), 0.2)} + {points(any_hit(t, ('custom', 'modified')), 0.2)})"


_ASKED = f"regexp_extract_all({_LD}, '[\\p{{L}}\\p{{N}}_]+')"
_REASONING = f"({capped(hits(_LC, fixed.LOGIC), 0.1, 0.3)} + {capped(hits(_LC, fixed.EXPLAIN), 0.05, 0.2)} + (case when len({_ASKED}) > 0 then len(list_filter({_ASKED}, lambda w: contains({_LC}, w)))::double / len({_ASKED}) else 0::double end) * 0.3::double)"
_STACK = f"""list_reduce(list_prepend('', regexp_extract_all({_O}, '[()\\[\\]{{}}]')), lambda s, b: case when starts_with(s, 'x') then s when b in ('(', '[', '{{') then s || b
 when (b = ')' and ends_with(s, '(')) or (b = ']' and ends_with(s, '[')) or (b = '}}' and ends_with(s, '{{')) then left(s, length(s) - 1) else 'x' end) <> ''"""
_DOC = fixed.DOCSTRING.replace("'", "''")
_ANSWER = "(" + " + ".join([points(f"regexp_matches({_O}, '(?s)```.*?```')", 0.3), points(f"regexp_matches({_O}, 'def [A-Za-z0-9_]+\\(|class [A-Za-z0-9_]+')", 0.2), points(f"contains({_O}, '#') or regexp_matches({_O}, '{_DOC}')", 0.2), points(f"regexp_matches({_O}, '{fixed.NAME}')", 0.1), points(_STACK, -0.5)]) + ")"


@query(f"select pair_id, round({_groups(_LC)}, 12) as groups, round({_technical(_LC, _O)}, 12) as technical, round({_novelty(_LC)}, 12) as novelty, round({_REASONING}, 12) as reasoning, round({_ANSWER}, 12) as code from script_pairs")
def reward_parts(spark: SparkSession, d: str) -> DataFrame:
    parts = {"groups": score.group_score("output"), "technical": score.technical_score("output"), "novelty": score.novelty_score("output"), "reasoning": score.reasoning_score("input", "output"), "code": score.answer_code_score("output")}
    return table(spark, d, "script_pairs").select("pair_id", *[F.round(c, 12).alias(n) for n, c in parts.items()])


_COMPOSITE = f"""{_ANSWER} * 0.3::double + {_REASONING} * 0.25::double + {_groups(_LC)} * 0.2::double + {_technical(_LC, _O)} * 0.15::double + {_novelty(_LC)} * 0.1::double
+ {points(any_hit(_LC, fixed.RISKS), 0.15)} + {points(f"regexp_matches({_O}, '(?s){chr(34) * 3}.*?{chr(34) * 3}')", 0.2)} + {points(f"{chars('output')} < 50 or contains({_LC}, 'incomplete')", -0.3)}"""


@query(f"select pair_id, round(greatest(-1.0::double, least(1.0::double, {_COMPOSITE})), 12) as reward from script_pairs")
def composite_rewards(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "script_pairs").select("pair_id", F.round(score.composite_reward("input", "output"), 12).alias("reward"))


_SD, _SC = f"lower({_DESC})", f"lower({_CODE})"
_GIVEN = lambda k: f"coalesce(try_cast(description as json)->>'$.{k}' not in ('', '[]', '{{}}', '0', 'false'), false)"
_COMPLETE = " + ".join([
    *[points(f"{c} is not null", w) for c, w in (("name", 0.1), ("description", 0.2), ("source_code", 0.3), ("preview_title", 0.2))], *[points(_GIVEN(k), 0.1) for k in ("key_concepts", "mathematical_models", "evaluation_metrics")],
    points(f"contains({_SC}, 'stop') and contains({_SC}, 'loss')", 0.05), points(any_hit(_SC, ("entry", "buy")), 0.05), points(any_hit(_SC, ("exit", "sell")), 0.05), points(f"contains({_SC}, 'risk')", 0.05),
    points(any_hit(_SC, ("def ", "class ")), 0.1), points(f"contains({_SC}, 'import')", 0.05),
])


@query(f"select row_id, round(least(1.0::double, {_COMPLETE}), 12) as reward from strategies")
def completeness_rewards(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "strategies").select("row_id", F.round(score.completeness_reward("name", "description", "source_code", "preview_title"), 12).alias("reward"))


_TB = trim("b")
_FENCED = f"list_transform(regexp_extract_all({_O}, '(?is)```(?:python)?(.*?)```', 1), lambda b: {_TB})"
_BLOCKS = f"list_filter(case when len({_FENCED}) > 0 then {_FENCED} when {any_hit(_O, ('def ', 'class ', 'import ', 'from ', 'bt.'))} then [{trim(_O)}] else [] end, lambda b: length(b) > 10)"
_POINTS = " + ".join([
    points("regexp_matches(b, '(?m)^[ \\t]*(?:import|from) ')", 1), points("contains(b, 'def ')", 2), points("contains(b, 'class ')", 1.5), points(f"contains(b, '{chr(34) * 3}') or contains(b, repeat(chr(39), 3))", 1), points("contains(b, '#')", 0.5),
    points("regexp_matches(b, '(?m)^(?:    |\\t)[ \\t]*[^ \\t\\r\\n]')", 1), points(any_hit("lower(b)", fixed.TRADING), 1),
])
_BLOCK = f"(case when len({_BLOCKS}) = 0 then 0.1::double else least(list_sum(list_transform({_BLOCKS}, lambda b: {_POINTS})) / 10.0::double, 1.0::double) end)"


@query()
def parsed_rewards(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "script_pairs").withColumn("valid", score.parsing_blocks(score.answer_blocks("output")))
    return rows.select("pair_id", F.round(score.small_reward("input", "output", F.col("valid")), 12).alias("reward"))


@query(f"select pair_id, round(0.4::double * {_BLOCK} + 0.3::double * {_length('output')} + 0.3::double * {_relevance(f'lower({_I} || chr(32) || {_O})')}, 12) as reward from script_pairs")
def small_rewards(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "script_pairs").select("pair_id", F.round(score.small_reward("input", "output"), 12).alias("reward"))


@query("select pair_id, round(case when quality_score is null or likes_count is null then 0.1::double else greatest(0.0::double, least(1.0::double, quality_score / 10 * 0.6::double + likes_count / 100.0::double * 0.4::double)) end, 12) as reward from script_pairs")
def judged_rewards(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "script_pairs").select("pair_id", F.round(score.judged_reward(F.col("quality_score") / 10, F.col("likes_count") / 100.0), 12).alias("reward"))


def _analyses(spark: SparkSession, d: str) -> DataFrame:
    """Analyses as JSON, of the scripts' own fields; among them some that aren't objects, aren't JSON or tell an error."""
    parts = F.split(F.coalesce("description", F.lit("")), "[.]")
    whole = F.to_json(F.struct(
        F.coalesce("name", F.lit("")).alias("title"), F.coalesce("description", F.lit("")).alias("abstract"), F.struct(F.left(F.coalesce("source_code", F.lit("")), F.lit(40)).alias("algorithms")).alias("main_algorithms"), F.slice(parts, 1, 12).alias("key_concepts"),
        F.slice(parts, 1, 2).alias("mathematical_models"), F.coalesce("symbol", F.lit("")).alias("implementation_requirements"), F.struct(F.lit(1).alias("x")).alias("evaluation_metrics"), F.col("crawl_page").alias("datasets_mentioned"), F.struct(F.left(F.coalesce("description", F.lit("")), F.lit(21)).alias("abstract_preview")).alias("content_preview"),
    ))
    error = F.lit('{"title": "a title of some length here", "error": "none"}')
    text_ = F.when(F.expr("row_id % 7 = 0"), error).when(F.expr("row_id % 7 = 1"), F.col("description")).when(F.expr("row_id % 7 = 2"), F.lit("[1, 2]")).otherwise(whole)
    return table(spark, d, "strategies").select("row_id", "name", "description", "source_code", "symbol", text_.alias("analysis"))


_PART = f"string_split({_DESC}, '.')"
_ANALYSIS = f"""(15 * ({chars('description')} > 20)::int + 5 * ({chars('name')} > 20)::int + 15 * (least({chars('source_code')}, 40) > 30)::int + (case when len({_PART}) >= 3 then 10 else 5 end)
+ (case when len({_PART}) >= 2 then 5 else 5 end) + 10 * ({chars('symbol')} > 20)::int + 2.5 + 5 * (least({chars('description')}, 21) > 20)::int + 5 * (len({_PART}) >= 5)::int + 5 * (len({_PART}) >= 10)::int)::double"""


@query(f"select row_id, case when row_id % 7 < 3 then 0.0::double else {_ANALYSIS} end as score from strategies")
def analysis_scores(spark: SparkSession, d: str) -> DataFrame:
    return _analyses(spark, d).select("row_id", score.analysis_score(F.try_parse_json("analysis")).alias("score"))


_IS_WHOLE, _Q = "(row_id % 7 >= 3)", "chr(39)"
_LIST = lambda k: f"array_to_string(list_transform({_PART}[1:{k}], lambda x: '- ' || x), chr(10))"
_TEXT_OR = "coalesce(case row_id % 7 when 2 then '[1, 2]' else description end, '')"


@query(f"""select row_id, 'Create a trading strategy called ' || {_Q} || case when row_id % 7 = 0 then 'a title of some length here' else coalesce(name, '') end || {_Q} || '.'
|| (case when {_IS_WHOLE} then case when {_DESC} <> '' then ' Strategy description: ' || description else '' end when row_id % 7 = 0 then '' when {_TEXT_OR} <> '' then ' Strategy description: ' || {_TEXT_OR} else '' end)
|| (case when {_IS_WHOLE} and array_to_string({_PART}[1:5], ', ') <> '' then ' Focus on these key concepts: ' || array_to_string({_PART}[1:5], ', ') else '' end)
|| coalesce(' The strategy should work with these instruments: ' || symbol, '')
|| ' Include the following in your response: 1. Clear entry and exit conditions 2. Risk management rules 3. Complete implementation code 4. Explanation of the strategy logic 5. Key parameters and their rationale' as prompt,
'# ' || coalesce(name, '') || chr(10) || (case when {_IS_WHOLE} then chr(10) || '## Strategy Overview' || chr(10) || {_DESC} || chr(10) || chr(10) || '## Key Concepts' || chr(10) || {_LIST(12)} || chr(10) || chr(10) || '## Mathematical Models' || chr(10)
|| {_LIST(2)} || chr(10) when row_id % 7 = 1 then coalesce(chr(10) || '## Description' || chr(10) || description || chr(10), '') else '' end)
|| coalesce(chr(10) || '## Implementation' || chr(10) || chr(10) || '```python' || chr(10) || source_code || chr(10) || '```' || chr(10), '') || coalesce(chr(10) || '## Applicable Instruments' || chr(10) || symbol || chr(10), '') as response from strategies""")
def strategy_messages(spark: SparkSession, d: str) -> DataFrame:
    """Prompts and Markdown answers from descriptions that are analyses, other JSON or plain text."""
    none = F.lit(None).cast("string")
    return _analyses(spark, d).select("row_id", prompts.strategy_prompt("name", "analysis", "symbol").alias("prompt"), prompts.strategy_response("name", "analysis", none, "source_code", "symbol").alias("response"))


@query("""select doc_id, case when regexp_matches(text, '(?:^|[^\\p{L}\\p{N}_])[0-9]{1,3}(?:[^\\p{L}\\p{N}_]|$)') then least(regexp_extract(text, '(?:^|[^\\p{L}\\p{N}_])([0-9]{1,3})(?:[^\\p{L}\\p{N}_]|$)', 1)::double / 100.0, 1.0) else 0.5::double end as score from documents""")
def percent_scores(spark: SparkSession, d: str) -> DataFrame:
    """The first number of up to three digits in a text as a share of 100."""
    return table(spark, d, "documents").select("doc_id", text.percent_score("text").alias("score"))


@query()
def judged_codes(spark: SparkSession, d: str) -> DataFrame:
    """Syntax of the first fenced block and a judge's answer together."""
    return table(spark, d, "script_pairs").select("pair_id", F.round(score.judged_code("output", F.col("quality_score").cast("string")), 6).alias("score"))


# Statistics.


@query(f"select count(*) as total, count_if(kind = 'strategy') as strategies, count_if(kind = 'indicator') as indicators, count_if(kind = 'unknown') as others, count_if(plots) as with_plots from (select {_KIND} as kind, regexp_matches({_CODE}, '{fixed.PLOTS}') as plots from strategies)")
def kind_counts(spark: SparkSession, d: str) -> DataFrame:
    t = classify.script_traits("source_code", "description")
    rows = table(spark, d, "strategies").select(t["kind"].alias("kind"), t["has_plots"].alias("plots"))
    return aggregate.condition_counts(rows, {"strategies": F.col("kind") == "strategy", "indicators": F.col("kind") == "indicator", "others": F.col("kind") == "unknown", "with_plots": F.col("plots")})


@query("""select count(s) as n, round(coalesce(avg(s), 0), 6) as mean, round(coalesce(min(s), 0), 6) as low, round(coalesce(max(s), 0), 6) as high, count_if(s >= 9) as excellent, count_if(s >= 7 and s < 9) as good, count_if(s >= 5 and s < 7) as average,
count_if(s >= 3 and s < 5) as poor, count_if(s < 3) as very_poor from (select quality_score as s from script_pairs)""")
def score_summary(spark: SparkSession, d: str) -> DataFrame:
    return aggregate.score_summary(table(spark, d, "script_pairs"), "quality_score")


@query(f"""select count(*) as scripts, count_if(removed > 0) as cleaned, sum(removed)::bigint as removed, round(case when count_if(removed > 0) > 0 then sum(removed)::double / count_if(removed > 0) else 0 end, 6) as per_cleaned,
round(count_if(removed > 0) * 100.0::double / count(*), 4) as percent from (select coalesce(len(list_filter({lines('source_code')}, lambda l: regexp_matches(l, '{fixed.DRAWING_LINE}'))), 0) as removed from strategies)""")
def cleaning_stats(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "strategies").select(clean.drawing_removed("source_code")["removed"].alias("removed"))
    n = F.count_if(F.col("removed") > 0)
    return rows.agg(F.count("*").alias("scripts"), n.alias("cleaned"), F.sum("removed").alias("removed"), F.round(F.when(n > 0, F.sum("removed") / n).otherwise(F.lit(0.0)), 6).alias("per_cleaned"), aggregate.rate(n, F.count("*")).alias("percent"))


def _quantile(p: float) -> str:
    h = f"((n + 1) * {p}::double)"
    j = f"least(greatest(floor({h}), 1), greatest(n - 1, 1))::bigint"
    least = {0.25: 4, 0.75: 4, 0.95: 20, 0.99: 100}[p]
    return f"round(case when n < {least} then v[{'1' if p < 0.5 else 'n'}] else v[{j}] + ({h} - {j}) * (v[least({j} + 1, n)] - v[{j}]) end, 6)"


_POINTS_P = (0.25, 0.75, 0.95, 0.99)
_WORDS = words("text")


@query(f"select doc_kind, {', '.join(f'{_quantile(p)} as p{p * 100:g}' for p in _POINTS_P)}, v[n // 2 + 1] as median from (select doc_kind, list_sort(list(w)) as v, len(list(w)) as n from (select doc_kind, ({_WORDS})::double as w from documents) group by 1)")
def length_quantiles(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("doc_kind", text.word_count("text").alias("w"))
    return aggregate.exclusive_quantiles(rows, "w", _POINTS_P, ["doc_kind"], median=True)


@query(f"select source, count(w) as n, sum(w)::bigint as total, min(w) as low, max(w) as high, round(avg(w), 6) as mean, round(coalesce(stddev_samp(w), 0), 6) as stdev from (select coalesce(source, '') as source, {_WORDS} as w from documents) group by 1")
def length_stats(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select(F.coalesce("source", F.lit("")).alias("source"), text.word_count("text").alias("w"))
    return aggregate.length_stats(rows, "w", ["source"])


_EDGES = fixed.LENGTH_EDGES
_BUCKET = "case " + " ".join(f"when w >= {a} and w < {b} then '{a}-{b - 1}'" for a, b in zip(_EDGES, _EDGES[1:])) + f" when w >= {_EDGES[-1]} then '{_EDGES[-1]}+' end"


@query(f"select bucket, count(*) as n, round(count(*) * 100.0::double / sum(count(*)) over (), 4) as percent from (select {_BUCKET} as bucket from (select {_WORDS} as w from documents)) group by 1")
def length_histogram(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select(aggregate.bucketed(text.word_count("text"), _EDGES).alias("b"))
    return aggregate.histogram(rows, "bucket", "b")


@query("select count(*) as n, round(avg(a), 6) as mean_a, round(avg(b), 6) as mean_b, count_if(a > b) as wins, count_if(a < b) as losses, count_if(a = b) as ties, round(avg(a - b), 6) as difference from (select likes_count::double as a, preview_likes_count::double as b from strategies) where a is not null and b is not null")
def paired_comparison(spark: SparkSession, d: str) -> DataFrame:
    return aggregate.paired_comparison(table(spark, d, "strategies"), F.col("likes_count").cast("double"), F.col("preview_likes_count").cast("double"))


@query(f"select count(*) as total, count_if(not {blank('source_code')}) as with_code, count_if(coalesce(user_info.username <> '', false)) as with_user, sum({_LIKES})::bigint as likes from strategies")
def completeness_counts(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "strategies")
    counts = {"with_code": ~text.is_blank("source_code"), "with_user": F.col("user_info.username") != ""}
    return rows.agg(F.count("*").alias("total"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in counts.items()], F.sum(likes()).alias("likes"))


@query("select count(*) as n, count_if(name is not distinct from preview_title) as same, round(count_if(name is not distinct from preview_title) * 100.0::double / count(*), 4) as percent from strategies")
def preview_agreement(spark: SparkSession, d: str) -> DataFrame:
    return aggregate.agreement_rate(table(spark, d, "strategies"), "name", "preview_title")


@query("select segment_id // 100 as batch, count(*) as total, count_if(length(output) > 60) as accepted, count(*) - count_if(length(output) > 60) as rejected, round(count_if(length(output) > 60) * 100.0::double / count(*), 4) as acceptance from segments group by 1")
def batch_stats(spark: SparkSession, d: str) -> DataFrame:
    return aggregate.batch_stats(table(spark, d, "segments"), "segment_id", 100, F.length("output") > 60)


_PROFILE = " union all ".join(f"select '{c}' as \"column\", count({c}) as filled, count(*) as rows from script_pairs" for c in ("pair_id", "input", "output", "script_id", "name", "author", "likes_count", "was_translated", "original_language", "quality_score", "made_at"))


@query(_PROFILE)
def pair_profile(spark: SparkSession, d: str) -> DataFrame:
    return column_profile(table(spark, d, "script_pairs")).select("column", "filled", "rows")


# Selection.


@query(f"select row_id, {_LIKES} as likes from strategies order by likes desc, row_id limit 50")
def top_likes(spark: SparkSession, d: str) -> DataFrame:
    return select.top_k(table(spark, d, "strategies").select("row_id", likes().alias("likes")), "likes", "row_id", 50)


@query(f"select row_id, likes from (select row_id, {_LIKES} as likes, {blank('source_code')} as empty from strategies order by likes desc, row_id limit 100) where not empty")
def top_likes_with_code(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "strategies").select("row_id", likes().alias("likes"), text.is_blank("source_code").alias("empty"))
    return select.top_k_then(rows, "likes", "row_id", 100, ~F.col("empty")).select("row_id", "likes")


@query(f"select theme, row_id, likes, rank from (select *, row_number() over (partition by theme order by likes desc, row_id) as rank from ({_BUCKETS})) where rank <= 2")
def top_by_theme(spark: SparkSession, d: str) -> DataFrame:
    rows = classify.by_theme(table(spark, d, "strategies").select("row_id", "description", likes().alias("likes")), "description")
    return select.top_k_per_group(rows, "theme", "likes", "row_id", 2).select("theme", "row_id", "likes", "rank")


@query("select script_id, pair_id, quality_score from (select *, row_number() over (partition by script_id order by quality_score desc, pair_id) as n from script_pairs where quality_score is not null) where n = 1")
def best_pairs(spark: SparkSession, d: str) -> DataFrame:
    return select.best_of(table(spark, d, "script_pairs").select("script_id", "pair_id", "quality_score"), "script_id", "quality_score", "pair_id")


@query(f"select row_id, rank from (select row_id, row_number() over (order by {_LIKES} desc, row_id) as rank from strategies) where rank between 10 and 19")
def rank_slice(spark: SparkSession, d: str) -> DataFrame:
    return select.ranks_between(table(spark, d, "strategies").select("row_id", likes().alias("likes")), "likes", "row_id", 10, 19).select("row_id", "rank")


@query("select row_id, crawl_page from (select *, row_number() over (partition by crawl_page order by row_id) as n from strategies) where n <= 3")
def page_caps(spark: SparkSession, d: str) -> DataFrame:
    return capped_per_page(table(spark, d, "strategies"), "crawl_page", "row_id", 3).select("row_id", "crawl_page")


# Mixing.


@query("select 'pair' as kind, input, output, name, null as segment_key from script_pairs union all select 'segment', input, output, null, segment_key from segments")
def united(spark: SparkSession, d: str) -> DataFrame:
    pairs = table(spark, d, "script_pairs").select(F.lit("pair").alias("kind"), "input", "output", "name")
    return mixing.united(pairs, table(spark, d, "segments").select(F.lit("segment").alias("kind"), "input", "output", "segment_key"))


@query("""with n as (select floor(count(*) * (1 - 0.7::double) / 0.7::double)::bigint as want from script_pairs)
select pair_id as key, 'pairs' as origin from script_pairs union all
select key, 'segments' from (select segment_id as key, row_number() over (order by md5('42|' || segment_id), segment_id) as place from segments), n where place <= want""")
def ratio_mix(spark: SparkSession, d: str) -> DataFrame:
    a, b = table(spark, d, "script_pairs").select(F.col("pair_id").alias("key")), table(spark, d, "segments").select(F.col("segment_id").alias("key"))
    return mixing.mix(a, b, "key", 0.7, tags=("pairs", "segments"))


_AT = "row_number() over (order by md5('42|' || {k}), {k}) as place, count(*) over () as n"


@query(f"select pair_id, case when place <= floor(n * 0.8::double) then 'train' else 'test' end as part from (select pair_id, {_AT.format(k='pair_id')} from script_pairs)")
def exact_split(spark: SparkSession, d: str) -> DataFrame:
    return mixing.exact_split(table(spark, d, "script_pairs").select("pair_id"), "pair_id", 0.8)


@query(f"select segment_id, case when place <= floor(n * (case when n < 10 then 0.9::double else 0.8::double end)) then 'train' else 'val' end as part from (select segment_id, {_AT.format(k='segment_id')} from segments)")
def train_val_split(spark: SparkSession, d: str) -> DataFrame:
    return mixing.train_val_split(table(spark, d, "segments").select("segment_id"), "segment_id")


@query("select segment_id from segments order by md5('7|' || segment_id), segment_id limit 40")
def hash_sample(spark: SparkSession, d: str) -> DataFrame:
    return mixing.exact_sample(table(spark, d, "segments").select("segment_id"), "segment_id", 40, seed=7)


@query(f"select pair_id from script_pairs where {words('input')} + {words('output')} > 200")
def removed_pairs(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "script_pairs")
    return mixing.removed(rows.select("pair_id"), length_filter(spark, d), "pair_id")


@query("select pair_id, ('0x' || left(md5('42|' || pair_id), 8))::bigint % 10 as reference from script_pairs")
def assigned_references(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "script_pairs").select("pair_id", mixing.assigned_reference("pair_id", 10).alias("reference"))


# Pipelines.


_CLEAN = f"coalesce(array_to_string(list_filter({lines('source_code')}, lambda l: not regexp_matches(l, '{fixed.DRAWING_LINE}')), chr(10)), '')"


@query(f"""select * from (select row_id, description as input, cleaned as output, removed_lines, likes, title, {_quality('cleaned')} as score from
(select row_id, description, {_CLEAN} as cleaned, coalesce(len(list_filter({lines('source_code')}, lambda l: regexp_matches(l, '{fixed.DRAWING_LINE}'))), 0) as removed_lines, {_LIKES} as likes, coalesce(nullif(name, ''), nullif(preview_title, '')) as title from strategies where ({_REASON}) is null)) where score >= 5""")
def script_pipeline(spark: SparkSession, d: str) -> DataFrame:
    return pipelines.script_pipeline(table(spark, d, "strategies")).select("row_id", "input", "output", "removed_lines", "likes", F.col("name").alias("title"), "score")


@query("select row_id, array_to_string(list_filter([" + ", ".join(f"case when {c} then '{n}' end" for n, c in _T) + f"], lambda x: x is not null), ', ') as reasons, case when {' or '.join(c for _, c in _T)} then 'rejected' else 'completed' end as status, case when not ({' or '.join(c for _, c in _T)}) then {_CLEAN} end as core from strategies")
def restructure_pipeline(spark: SparkSession, d: str) -> DataFrame:
    return pipelines.restructure_pipeline(table(spark, d, "strategies")).select("row_id", "reasons", "status", F.try_element_at("components", F.lit("core_method"))["code"].alias("core"))


@query(f"""select segment_id, score from (select segment_id, round(greatest(1.0::double, least(10.0::double, {_SEGMENT})), 6) as score from
(select *, row_number() over (partition by {_KEY} order by {chars('input')} desc, segment_id) as n from segments where ({_SEG}) is null) where n = 1) where score >= 6""")
def segment_pipeline(spark: SparkSession, d: str) -> DataFrame:
    return pipelines.segment_pipeline(table(spark, d, "segments")).select("segment_id", F.round("score", 6).alias("score"))


@query(f"select status, count(*) as n from (select case when ({_KIND}) <> 'strategy' then 'rejected_by_classifier' when {words('description')} < 100 then 'rejected_by_filter' else 'completed' end as status from strategies) group by 1")
def agent_statuses(spark: SparkSession, d: str) -> DataFrame:
    return pipelines.status_counts(pipelines.agent_pipeline(table(spark, d, "strategies")))


# Operators that a model can back, offline.


@query(f"select doc_id, false as was_translated, text, 50.0::double as model_score from documents where regexp_matches(text, '{FILLED}')")
def offline_models(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").where(~text.is_blank("text")).select("doc_id", "text")
    return models.assessed(models.translated(rows, "text", text.is_foreign("text")), "text", unparsed=50.0)


@query(f"select segment_id, input, case when not {blank('input')} and not {blank('output')} then 5.0::double end as match_score, false as was_rewritten, not {blank('input')} and not {blank('output')} as rewrite_failed from segments")
def offline_rewrites(spark: SparkSession, d: str) -> DataFrame:
    """Without a model every match is 5, which asks for a new text that doesn't come."""
    out = models.rewritten(table(spark, d, "segments"), "input", "output")
    return out.select("segment_id", "input", "match_score", "was_rewritten", "rewrite_failed")


@query(f"select row_id, 0.0::double as analysis_score, 3 as candidates, 0 as attempts, false as valid, 'low' as confidence, 'Error: no answer' as generated_code, {_INSTRUCTION} as instruction from strategies")
def offline_stages(spark: SparkSession, d: str) -> DataFrame:
    """What analysis, conversion, validation, symbols, generation and reasoning give without a model."""
    rows = table(spark, d, "strategies")
    out = models.inferred_symbols(models.converted(models.best_analysis(rows, "description"), "source_code"), "description")
    out = models.reasoned(models.generated(out, F.col("description")), "description", "source_code")
    return out.select("row_id", "analysis_score", "candidates", F.col("conversion.attempts").alias("attempts"), models.validated("conversion.code").alias("valid"), "confidence", "generated_code", "instruction")


@query("select state_id, coalesce(array_to_string(list_transform(relevant_symbols[1:5], lambda s: upper(s)), ','), '') as symbols, case when coalesce(len(relevant_symbols), 0) > 0 then 'high' else 'low' end as confidence from processing_states")
def offline_symbols(spark: SparkSession, d: str) -> DataFrame:
    out = models.symbols_or_none("relevant_symbols")
    return table(spark, d, "processing_states").select("state_id", out["symbols"].alias("symbols"), out["confidence"].alias("confidence"))


# Reports.


_FIRST = f"case when {blank('input')} or {blank('output')} then 'empty' when {chars(trim('input'))} < 15 then 'short_description' when not coalesce({chars(trim('output'))} >= 20 and ({_SHAPES}) and not regexp_matches(output, '{fixed.NOTE_ONLY}'), false) then 'meaningless_code' end"


@query(f"select reason, count(*) as n, round(count(*) * 100.0::double / sum(count(*)) over (), 4) as percent from (select {_FIRST} as reason from segments) where reason is not null group by 1")
def first_pass_reasons(spark: SparkSession, d: str) -> DataFrame:
    return aggregate.breakdown(filters.with_reason(table(spark, d, "segments"), filters.first_pass_checks("input", "output")), "reason")


@query("select count(quality_score) as scored, round(coalesce(avg(quality_score), 0), 2) as mean from script_pairs")
def mean_quality(spark: SparkSession, d: str) -> DataFrame:
    return aggregate.mean_of_scored(table(spark, d, "script_pairs"), "quality_score")


@query("""with b as (select segment_id // 100 as batch, count(*) as total, count_if(length(output) > 60) as accepted from segments group by 1)
select (select count(*) from b) as batches, (select round(sum(accepted) * 100.0::double / sum(total), 4) from b) as acceptance, (select string_agg(batch || ': ' || accepted || '/' || total, ', ' order by batch desc) from (from b order by batch desc limit 5)) as latest""")
def batch_summary(spark: SparkSession, d: str) -> DataFrame:
    return aggregate.batch_summary(aggregate.batch_stats(table(spark, d, "segments"), "segment_id", 100, F.length("output") > 60))


@query("""with a as (select count(*) as n from script_pairs), b as (select count(*) as n from segments), g as (select a.n as x, least(floor(a.n * (1 - 0.7::double) / 0.7::double)::bigint, b.n) as y, a.n as ta, b.n as tb from a, b)
select 'pairs' as origin, x as rows, round(x::double / (x + y), 6) as share, 0.7::double as wanted_share, ta as available from g union all select 'segments', y, round(y::double / (x + y), 6), 0.3::double, tb from g""")
def mix_report(spark: SparkSession, d: str) -> DataFrame:
    a, b = table(spark, d, "script_pairs").select(F.col("pair_id").alias("key")), table(spark, d, "segments").select(F.col("segment_id").alias("key"))
    return mixing.mix_stats(mixing.mix(a, b, "key", 0.7, tags=("pairs", "segments")), 0.7, {"pairs": a, "segments": b})


_ORDER = "case theme when 'complex_indicators' then 1 when 'multi_timeframe' then 2 when 'risk_management' then 3 when 'machine_learning' then 4 else 5 end"


@query(f"select * from (select theme, row_id, likes, row_number() over (order by {_ORDER}, rank) as place from (select *, row_number() over (partition by theme order by likes desc, row_id) as rank from ({_BUCKETS})) where rank <= 2) where place <= 6")
def challenging_cases(spark: SparkSession, d: str) -> DataFrame:
    rows = classify.by_theme(table(spark, d, "strategies").select("row_id", "description", likes().alias("likes")), "description")
    return select.best_of_each(rows, "theme", [n for n, _ in classify.BUCKETS], "likes", "row_id").select("theme", "row_id", "likes", "place")


@query("""select source_id, author, key, input, output from (select coalesce(source_id, 'unknown') as source_id, coalesce(min(source_author) over (partition by coalesce(source_id, 'unknown')), 'unknown') as author, segment_key as key, input, output,
row_number() over (partition by coalesce(source_id, 'unknown'), segment_key order by coalesce(length(output), -1) desc, coalesce(output, '') desc, coalesce(input, '') desc) as n
from segments) where key is not null and n = 1 and input is not null and output is not null""")
def unpacked_lineage(spark: SparkSession, d: str) -> DataFrame:
    """Parts from a nested path, with the columns that tell where they come from."""
    rows = table(spark, d, "segments").withColumn("source_id", F.coalesce("source_id", F.lit("unknown")))
    maps = nested.packed(rows, "source_id", "segment_key", "input", "output").join(rows.groupBy("source_id").agg(F.min("source_author").alias("author")), "source_id")
    held = maps.select("source_id", "author", F.struct("components").alias("metadata"), F.lit(None).cast(nested.COMPONENT).alias("components"))
    return nested.unpacked_nested(held, "source_id", ["metadata.components", "components"], ["author"])


@query("select event_id, case when try_cast(json_extract(props, '$.k') as bigint) is null then 0 else greatest(0, least(100, try_cast(json_extract(props, '$.k') as bigint) * 30)) end as score, event_id % 2 = 0 as passed, case when event_id % 3 = 0 then 'fine' else '' end as reason from events")
def checked_assessments(spark: SparkSession, d: str) -> DataFrame:
    """Judges' answers in fences, with fields that are missing or of another type."""
    passed = F.when(F.expr("event_id % 2 = 0"), "true").otherwise('"yes"')
    reason = F.when(F.expr("event_id % 3 = 0"), ', "reason": "fine"').otherwise("")
    answer = F.concat(F.lit('Here:\n```json\n{"score": '), F.coalesce((nested.parsed("props", "k bigint")["k"] * 30).cast("string"), F.lit('"none"')), F.lit(', "passed": '), passed, reason, F.lit("}\n```"))
    return table(spark, d, "events").select("event_id", *[c.alias(n) for n, c in nested.checked_assessment(answer).items()])


@query("""select * from (values ('https://scripts.example/top/?t=1', 1, 'https://scripts.example/top/?t=1'), ('https://scripts.example/top/?t=1', 2, 'https://scripts.example/top/page-2/?t=1'), ('https://scripts.example/top/?t=1', 3, 'https://scripts.example/top/page-3/?t=1'),
('https://scripts.example/picks/', 1, 'https://scripts.example/picks/')) t(listing, page, url)""")
def listing_pages(spark: SparkSession, d: str) -> DataFrame:
    return listing_plan(spark, [("https://scripts.example/top/?t=1", 3), ("https://scripts.example/picks/", 1)], 1, 3)


@query("select doc_id, text as decoded from documents")
def escapes_decoded(spark: SparkSession, d: str) -> DataFrame:
    """Texts as JSON string literals, decoded again."""
    literal = F.expr("substring(to_json(named_struct('s', text)), 7, length(to_json(named_struct('s', text))) - 8)")
    return table(spark, d, "documents").select("doc_id", F.when(F.col("text").isNotNull(), clean.escapes_decoded(literal)).alias("decoded"))
