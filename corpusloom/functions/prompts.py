"""Prompt and training-text formats as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import _c, lines, trimmed
from corpusloom.operators.classify import instruction_for

# Fixed values.
INSTRUCTION = "Generate Pine Script v6 code based on the following trading strategy description."
SYSTEM = "You are a helpful assistant that generates Pine Script code for trading strategies."
ALPACA = "Below is an instruction that describes a task, paired with an input that provides further context. Write a response that appropriately completes the request."
ALPACA_TASK = "Generate Pine Script v6 code for the given trading strategy description."
TRAINING = "Below is an instruction that describes a task. Write a response that appropriately completes the request."


def _text(c: Column | str) -> Column:
    return F.coalesce(_c(c), F.lit(""))


def instruction(a: Column | str, b: Column | str, text: str = INSTRUCTION, given: str = "Description:", answer: str = "Code:") -> Column:
    return F.concat(F.lit(f"### Instruction:\n{text}\n\n### {given}\n"), _text(a), F.lit(f"\n\n### {answer}\n"), _text(b))


def conversation(a: Column | str, b: Column | str, user: str = "Human:", assistant: str = "Assistant:", system: str = SYSTEM) -> Column:
    return F.concat(F.lit(f"System: {system}\n\n{user} "), _text(a), F.lit(f"\n\n{assistant} "), _text(b))


def chatml(a: Column | str, b: Column | str, system: str = SYSTEM) -> Column:
    return F.concat(F.lit(f"<|im_start|>system\n{system}<|im_end|>\n<|im_start|>user\n"), _text(a), F.lit("<|im_end|>\n<|im_start|>assistant\n"), _text(b), F.lit("<|im_end|>"))


def alpaca(a: Column | str, b: Column | str, task: str = ALPACA_TASK) -> Column:
    return F.concat(F.lit(f"{ALPACA}\n\n### Instruction:\n{task}\n\n### Input:\n"), _text(a), F.lit("\n\n### Response:\n"), _text(b))


def training(a: Column | str, b: Column | str) -> Column:
    """The form in which lengths are measured before training."""
    return F.concat(F.lit(f"{TRAINING}\n\n### Instruction:\n"), _text(a), F.lit("\n\n### Response:\n"), _text(b))


def simple(a: Column | str, b: Column | str, separator: str = "\n\n") -> Column:
    return F.concat(_text(a), F.lit(separator), _text(b))


FORMATS: dict[str, Callable[..., Column]] = {"instruction": instruction, "conversation": conversation, "chatml": chatml, "alpaca": alpaca, "simple": simple, "training": training}


def formatter(name: str) -> Callable[..., Column]:
    if name not in FORMATS:
        raise ValueError(f"unknown format {name!r}; known are {', '.join(FORMATS)}")
    return FORMATS[name]


def formatted(df: DataFrame, name: str, a: str = "input", b: str = "output", **options: str) -> DataFrame:
    """(text): every row in the named format."""
    return df.select(formatter(name)(a, b, **options).alias("text"))


# Fixed texts of generation prompts.
EXAMPLES_HEAD = "You are an expert TradingView Pine Script developer. Based on strategy descriptions, generate complete Pine Script code.\n\nHere are some examples:\n\n"
TARGET = ("Now generate Pine Script code for this strategy:\n\nDescription: ", "\n\nPine Script Code:")
ZERO_SHOT = (
    "You are an expert TradingView Pine Script developer. Generate complete and functional Pine Script code for the following trading strategy:\n\nDescription: ",
    "\n\nPlease generate complete Pine Script v5 code that implements this strategy. Include all necessary components like strategy declaration, inputs, calculations, entry/exit logic, and plotting.\n\nPine Script Code:",
)
OUTLINE_HEAD = ("You are an expert Pine Script developer. Generate high-quality Pine Script v5 code based on strategy descriptions.\n\nHere are ", " examples of successful trading strategies:\n\n")
OUTLINE_TARGET = (
    "\n" + "=" * 60 + "\nTARGET STRATEGY\n" + "=" * 60 + "\n\nGenerate complete Pine Script v5 code for this strategy:\n\nDescription: ",
    "\n\nRequirements:\n1. Use //@version=5\n2. Include strategy() declaration\n3. Add input parameters\n4. Implement core strategy logic\n5. Add entry/exit conditions\n6. Include risk management\n7. Add plotting/visualization\n8. Follow the patterns shown in examples above\n\nPine Script Code:",
)
PLAIN_HEAD = "You are an expert in generating TradingView Pine Script code for trading strategies. \nBased on the description provided, generate complete and functional Pine Script code.\n\nHere are some examples of descriptions and their corresponding Pine Script code:\n\n"
PLAIN_TARGET = ("\n\n\nNow, based on the following description, generate the corresponding TradingView Pine Script code:\n\nDescription: ", "\n\nGenerated TradingView Pine Script Code:")
PLAIN_ZERO_SHOT = (
    "You are an expert in generating TradingView Pine Script code for trading strategies.\nBased on the description provided, generate complete and functional Pine Script code.\n\nDescription: ",
    "\n\nPlease generate a complete TradingView Pine Script code that implements the described strategy. \nThe code should be functional and follow Pine Script v5 syntax.\n\nGenerated TradingView Pine Script Code:",
)
PATTERN_HEAD = (
    "You are an expert Pine Script developer specializing in advanced trading strategies. Your task is to generate high-quality, functional Pine Script code based on strategy descriptions.\n\nKey requirements:\n- Use Pine Script v5 syntax\n- Include proper input parameters \n"
    "- Implement robust entry/exit logic\n- Add appropriate risk management\n- Include visualization elements\n- Follow Pine Script best practices\n\nHere are examples of high-quality strategy implementations:\n\n"
)
PATTERN_TARGET = (
    "Now, based on the patterns shown above, generate a complete Pine Script strategy for:\n\nDescription: ",
    "\n\nRequirements:\n1. Start with //@version=5\n2. Include strategy() declaration with appropriate parameters\n3. Add input parameters for key strategy settings\n4. Implement the core strategy logic based on the description\n5. Add proper entry and exit conditions\n"
    "6. Include risk management (stop loss, take profit)\n7. Add visualization elements (plots, shapes, etc.)\n8. Follow the coding patterns shown in the examples above\n\nGenerate the complete Pine Script code:",
)
MINIMAL = ("Generate a Pine Script trading strategy based on this description:\n\n", "\n\nPlease provide complete Pine Script v5 code.")


def shown_example(rank: Column | str, description: Column | str, code: Column | str, chars: tuple[int, int] = (200, 500)) -> Column:
    """An example of a prompt: the beginnings of its description and of its code."""
    return F.concat(F.lit("Example "), _c(rank).cast("string"), F.lit(":\nDescription: "), F.left(_text(description), F.lit(chars[0])), F.lit("...\n\nPine Script Code:\n"), F.left(_text(code), F.lit(chars[1])), F.lit("...\n\n---\n\n"))


def outlined_example(rank: Column | str, name: Column | str, likes: Column | str, description: Column | str, code: Column | str) -> Column:
    """An example of which only the telling lines are shown: version, declaration, inputs and entries."""
    bar = "=" * 50

    def some(term: str, k: int, head: str, shape: Callable[[Column], Column]) -> Column:
        picked = F.transform(F.slice(F.filter(lines(_text(code)), lambda x: F.contains(x, F.lit(term))), 1, k), shape)
        return F.when(F.size(picked) > 0, F.concat(F.lit(head), F.array_join(picked, ""))).otherwise(F.lit(""))

    version = F.get(F.filter(lines(_text(code)), lambda x: F.startswith(x, F.lit("//@version="))), F.lit(0))
    row = lambda x: F.concat(F.lit("  "), F.left(trimmed(x), F.lit(80)), F.lit("...\n"))
    return F.concat(
        F.lit(f"{bar}\nEXAMPLE "), _c(rank).cast("string"), F.lit(f"\n{bar}\nStrategy: "), F.coalesce(_c(name), F.lit("Unknown")), F.lit("\nLikes: "), F.coalesce(_c(likes), F.lit(0)).cast("string"), F.lit("\n\nDescription:\n"), F.left(_text(description), F.lit(400)), F.lit("...\n\n"),
        F.coalesce(F.concat(F.lit("Version: "), version, F.lit("\n")), F.lit("")), some("strategy(", 1, "Strategy Declaration: ", lambda x: F.concat(F.left(x, F.lit(100)), F.lit("...\n"))), some("input.", 3, "Input Examples:\n", row), some("strategy.entry", 2, "Entry Logic:\n", row), F.lit("\n"),
    )


def whole_example(description: Column | str, code: Column | str) -> Column:
    """An example with all of its text."""
    return F.concat(F.lit("\nDescription: "), _text(description), F.lit("\n\nGenerated TradingView Pine Script Code:\n"), _text(code), F.lit("\n"))


def pattern_example(rank: Column | str, name: Column | str, description: Column | str, code: Column | str) -> Column:
    """An example of which the patterns are shown: version, the declaration up to its first bracket, inputs and entries."""
    each = lines(_text(code))
    version = F.get(F.filter(each, lambda x: F.startswith(x, F.lit("//@version="))), F.lit(0))
    declared = F.regexp_extract(_text(code), r"strategy\([^)]*\)", 0)

    def some(term: str, k: int, head: str) -> Column:
        picked = F.transform(F.slice(F.filter(each, lambda x: F.contains(x, F.lit(term))), 1, k), lambda x: F.concat(F.lit("  "), trimmed(x), F.lit("\n")))
        return F.when(F.size(picked) > 0, F.concat(F.lit(head), F.array_join(picked, ""))).otherwise(F.lit(""))

    return F.concat(
        F.lit("=== EXAMPLE "), _c(rank).cast("string"), F.lit(" ===\nStrategy: "), F.coalesce(_c(name), F.lit("Unknown")), F.lit("\nDescription: "), F.left(_text(description), F.lit(300)), F.lit("...\n\n"), F.coalesce(F.concat(F.lit("Version: "), version, F.lit("\n")), F.lit("")),
        F.when(_text(code).contains("strategy("), F.concat(F.lit("Strategy Declaration: "), F.when(F.length(declared) > 100, F.concat(F.left(declared, F.lit(100)), F.lit("..."))).otherwise(declared), F.lit("\n"))).otherwise(F.lit("")),
        some("input.", 3, "Input Examples:\n"), some("strategy.entry", 2, "Entry Logic Examples:\n"), F.lit("\n" + "=" * 50 + "\n\n"),
    )


def few_shot(examples: DataFrame, rank: str, n: int, shown: Column, by: str = "") -> str:
    """The first ``n`` examples by rank as one text, in order. They are few by meaning; the same text goes into every prompt."""
    return by.join(r["text"] for r in examples.where(F.col(rank) <= n).select(rank, shown.alias("text")).orderBy(rank).limit(n).collect())


#: Style -> what stands before examples, and around the target after them; around the target without any.
EXAMPLE_STYLES = {"plain": (EXAMPLES_HEAD, TARGET), "whole": (PLAIN_HEAD, PLAIN_TARGET), "patterns": (PATTERN_HEAD, PATTERN_TARGET)}
ZERO_SHOT_STYLES = {"plain": ZERO_SHOT, "whole": PLAIN_ZERO_SHOT, "patterns": MINIMAL, "minimal": MINIMAL}


def generation_prompt(target: Column | str, examples: str | None = None, style: str = "plain", n: int = 0) -> Column:
    """What a model is asked to write code for: after examples (``plain``, ``outlined``, ``whole`` or ``patterns``; see the functions for
    an example of each), or without any (``plain``, ``whole`` or ``minimal``)."""
    if examples is None:
        before, after = ZERO_SHOT_STYLES[style]
        return F.concat(F.lit(before), _text(target), F.lit(after))
    head, (before, after) = (f"{OUTLINE_HEAD[0]}{n}{OUTLINE_HEAD[1]}", OUTLINE_TARGET) if style == "outlined" else EXAMPLE_STYLES[style]
    return F.concat(F.lit(head + examples + before), _text(target), F.lit(after))


def thought_answer(thought: Column | str, answer: Column | str) -> Column:
    return F.concat(F.lit("<think>\n"), _text(thought), F.lit("\n</think>\n<answer>\n"), _text(answer), F.lit("\n</answer>"))


# Fixed texts of reasoned answers.
THOUGHT = (
    "2. **Implementation Approach**: I need to break down this strategy into its core components and implement each part using appropriate Pine Script functions.",
    "3. **Technical Requirements**: Identify the necessary technical indicators, parameters, and conditional logic required for this strategy.",
    "4. **Code Structure**: Plan the implementation by determining the sequence of operations and proper Pine Script syntax to achieve the desired functionality.",
)
REWRAPPED_THOUGHT = (
    "2. **Implementation Requirements**: Based on the strategy description, I need to implement the core logic using appropriate Pine Script functions and syntax.",
    "3. **Code Structure Planning**: I'll analyze the required components and translate them into Pine Script syntax, considering proper variable naming, function usage, and logic flow.",
    "4. **Pine Script Translation**: Converting the conceptual strategy requirements into executable Pine Script code with appropriate technical indicators and conditional logic.",
)
TAGS = ("<think>", "</think>", "<answer>", "</answer>")


def reasoned_answer(description: Column | str, code: Column | str, steps: tuple[str, ...] = THOUGHT) -> Column:
    """A thought of fixed steps about the description, then the code."""
    return thought_answer(F.concat(F.lit("1. **Strategy Analysis**: "), _text(description), F.lit("\n\n" + "\n\n".join(steps))), code)


def rewrapped(content: Column | str, description: Column | str, code: Column | str) -> Column:
    """The content if it has all four tags of a thought and an answer, else a thought about the description and the code."""
    tagged = F.lit(True)
    for tag in TAGS:
        tagged = tagged & _text(content).contains(tag)
    return F.when(tagged, _text(content)).otherwise(reasoned_answer(description, code, REWRAPPED_THOUGHT))


def reasoned_pair(response: Column | str, description: Column | str, code: Column | str) -> dict[str, Column]:
    """Instruction and output of a model's response: by its markers, else an instruction by rule; the output is rewrapped."""
    text = _text(response)
    marked, parts = text.contains("INSTRUCTION:") & text.contains("OUTPUT:"), F.split(text, "OUTPUT:", -1)
    asked = F.when(marked, trimmed(F.replace(F.get(parts, F.lit(0)), F.lit("INSTRUCTION:"), F.lit("")))).otherwise(instruction_for(description))
    return {"instruction": asked, "output": rewrapped(F.when(marked, trimmed(F.get(parts, F.lit(1)))).otherwise(text), description, code)}


def _analysis(description: Column | str) -> tuple[Column, Column, Column]:
    """``(value, is_object, is_json)`` of a description that may be JSON."""
    value = F.try_parse_json(_c(description))
    return value, F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False)), value.isNotNull()


def _strings(value: Column, field: str) -> Column:
    return F.coalesce(F.try_variant_get(value, f"$.{field}", "array<string>"), F.array().cast("array<string>"))


ASKED = "Include the following in your response: 1. Clear entry and exit conditions 2. Risk management rules 3. Complete implementation code 4. Explanation of the strategy logic 5. Key parameters and their rationale"


def strategy_prompt(name: Column | str, description: Column | str, symbols: Column | str) -> Column:
    """The request for a strategy: title, abstract and first five concepts of a description that is a JSON object, else its text."""
    value, is_object, _ = _analysis(description)
    title = F.coalesce(F.try_variant_get(value, "$.title", "string"), _text(name))
    abstract = F.when(is_object, F.try_variant_get(value, "$.abstract", "string")).otherwise(_c(description))
    concepts = F.array_join(F.slice(_strings(value, "key_concepts"), 1, 5), ", ")
    given = lambda head, c: F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(head), c))
    return F.concat_ws(
        " ", F.concat(F.lit("Create a trading strategy called '"), F.when(is_object, title).otherwise(_text(name)), F.lit("'.")), given("Strategy description: ", abstract), given("Focus on these key concepts: ", concepts),
        F.concat(F.lit("The strategy should work with these instruments: "), _c(symbols)), F.lit(ASKED),
    )


def strategy_response(name: Column | str, description: Column | str, reasoning: Column | str, code: Column | str, symbols: Column | str) -> Column:
    """The answer to it as Markdown: sections of the description's parts, the logic, the code and the instruments; those that are
    null are left out, and so are empty lists."""
    value, is_object, is_json = _analysis(description)

    def listed(title: str, field: str) -> Column:
        items = F.transform(_strings(value, field), lambda x: F.concat(F.lit("- "), x))
        return F.when(F.size(items) > 0, F.concat(F.lit(f"## {title}\n"), F.array_join(items, "\n"), F.lit("\n")))

    section = lambda title, c: F.concat(F.lit(f"## {title}\n"), c, F.lit("\n"))
    return F.concat_ws(
        "\n", F.concat(F.lit("# "), _text(name), F.lit("\n")), F.when(is_object, section("Strategy Overview", F.try_variant_get(value, "$.abstract", "string"))), listed("Key Concepts", "key_concepts"), listed("Mathematical Models", "mathematical_models"),
        F.when(~is_json, section("Description", _c(description))), section("Strategy Logic", _c(reasoning)), F.concat(F.lit("## Implementation\n\n```python\n"), _c(code), F.lit("\n```\n")), section("Applicable Instruments", _c(symbols)),
    )


def instruction_output(c: Column | str) -> dict[str, Column]:
    """The parts of a response with ``INSTRUCTION:`` and ``OUTPUT:`` markers; without them all of it is the output."""
    text = _text(c)
    marked = text.contains("INSTRUCTION:") & text.contains("OUTPUT:")
    part = lambda p: trimmed(F.regexp_extract(text, p, 1))
    return {"instruction": F.when(marked, part(r"(?s)INSTRUCTION:(.*?)OUTPUT:")).otherwise(F.lit("")), "output": F.when(marked, part(r"(?s)OUTPUT:(.*)")).otherwise(text)}
