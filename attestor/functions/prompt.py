"""Prompt expressions (F3, F4 helpers, F9-F12): all built-in column functions.

The prompt is assembled with ``concat``/``when``/``transform`` so it is built
inside whole-stage codegen, row by row, without leaving the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must match the source pipeline (prompt text, in order).
# ---------------------------------------------------------------------------
SYSTEM_MESSAGE = (
    "You are an expert medical researcher with a strong "
    "understanding of medical and biological semantics."
)
PREAMBLE = (
    "Analyze the abstract carefully and provide your final answer as a JSON object.\n"
    "Use <think></think> tags to systematically reason through the evaluation "
    "before providing your final JSON response.\n\n"
)
INTRO = (
    "Please analyze whether the provided abstract supports the following triple.\n"
    "Carefully consider the subject, object, and predicate details.\n\n"
)
EQUIVALENT_NAMES_NOTE = "(check for ANY of these + common abbreviations in the abstract):\n"
MATCHING_RULES = (
    "**MATCHING RULES**:\n"
    "1. **Entity Matching**: Start with equivalent names from the provided lists above\n"
    "   - You MAY use your knowledge to recognize common abbreviations and variants "
    "of the equivalent names (e.g., 'AAA' from 'AAA gene/protein')\n"
    "   - BUT any alternative name you use MUST be clearly related to names in the provided list\n"
    "2. **Relationship Matching**: Match the predicate by its semantic meaning "
    "as defined in the PREDICATE DEFINITION section above\n"
    "   - Accept semantically equivalent expressions (synonyms, paraphrases) "
    "that convey the same relationship\n"
    "   - Reject relationships that are similar but semantically distinct "
    "from the defined predicate\n\n"
    "**CRITICAL REQUIREMENTS**:\n"
    "• Relationship MUST be between the SUBJECT and OBJECT from the triple\n"
    "• Do NOT confuse relationships involving other entities\n"
    "• Supporting sentences MUST EXPLICITLY MENTION BOTH SUBJECT and OBJECT (or equivalent names)\n\n"
    "**CRITICAL LOGIC RULES**:\n"
    "1. **Correlation ≠ Causation**: 'A correlates with B' does NOT support 'A causes B'\n"
    "2. **No Transitive Reasoning**: If X→A and X→B, does NOT mean A→B (must be direct)\n"
    "3. **Opposite = No**: Inverse relationship → answer 'no'\n"
    "4. **Both Entities Required**: Supporting sentences must mention BOTH entities "
    "(names from the equivalent names list or via common abbreviations)\n\n"
)
INSTRUCTIONS = (
    "**INSTRUCTIONS**:\n"
    "- Determine if the abstract provides evidence for this triple.\n"
    '- Use "yes" if the relation is explicitly supported.\n'
    '- Use "no" if the relation is not mentioned or contradicted.\n'
    '- Use "maybe" if the evidence is indirect, ambiguous, or suggestive.\n'
    '- If "yes", return one or more exact supporting sentences from the abstract.\n'
    "  Multiple sentences are allowed if they together support the triple.\n"
    '- If "no" or "maybe", return an empty list for "sentences".\n'
    "- For subject_mentioned / object_mentioned: set to true if the entity appears\n"
    "  ANYWHERE in the abstract (using equivalent names or common abbreviations).\n"
    "  Entity mention is INDEPENDENT from whether the triple is supported.\n"
    '- For "reasoning": briefly explain why you chose yes/no/maybe.\n\n'
)
OUTPUT_FORMAT = (
    "**OUTPUT** (JSON only, no other text):\n"
    "{\n"
    '  "support": "yes" | "no" | "maybe",\n'
    '  "sentences": ["exact sentence from abstract", ...],\n'
    '  "subject_mentioned": true/false,\n'
    '  "object_mentioned": true/false,\n'
    '  "reasoning": "brief explanation of your judgment"\n'
    "}\n"
)
BIOLINK_PREFIX = "biolink:"
DEFAULT_MAX_TOKENS = 4096
MIN_MAX_TOKENS = 512
TOKEN_MARGIN = 64
CHARS_PER_TOKEN = 4
# ---------------------------------------------------------------------------


def display_predicate(p: Column) -> Column:
    """drop a leading ``biolink:``, underscores to spaces (no regex)."""
    bare = F.when(p.startswith(BIOLINK_PREFIX), F.substring(p, len(BIOLINK_PREFIX) + 1, 1 << 30)) \
        .otherwise(p)
    return F.translate(bare, "_", " ")


def canonical_predicate(p: Column) -> Column:
    """F4 fallback key: ``biolink:`` + spaces as underscores."""
    return F.concat(F.lit(BIOLINK_PREFIX), F.translate(p, " ", "_"))


def triple_text(subject: Column, predicate: Column, obj: Column, display: bool = True) -> Column:
    """``'s' p 'o'`` (display form strips the biolink prefix)."""
    p = display_predicate(predicate) if display else predicate
    return F.concat(F.lit("'"), subject, F.lit("' "), p, F.lit(" '"), obj, F.lit("'"))


def _line(label: str, value: Column) -> Column:
    return F.when(F.coalesce(value, F.lit("")) != "", F.concat(F.lit(label), value, F.lit("\n"))) \
        .otherwise(F.lit(""))


def entity_section(kind: str, name: Column, info: Column, names: Column) -> Column:
    """F9 part: entity header, optional Name/Category/Description lines and the
    numbered equivalent names. ``info`` is a struct (null when unknown)."""
    label = kind.upper()
    info_lines = F.when(
        info.isNotNull(),
        F.concat(
            _line("  Name: ", info.getField("name")),
            _line("  Category: ", info.getField("category")),
            _line("  Description: ", info.getField("description")),
        ),
    ).otherwise(F.lit(""))
    numbered = F.array_join(
        F.transform(
            names,
            lambda n, i: F.concat(F.lit("  "), (i + 1).cast("string"), F.lit(". "), n, F.lit("\n")),
        ),
        "",
    )
    return F.concat(
        F.lit(f"**{label}**: "), name, F.lit("\n"),
        info_lines,
        F.lit(f"\n**{label} EQUIVALENT NAMES** {EQUIVALENT_NAMES_NOTE}"),
        numbered,
    )


def bare_entity_section(kind: str, name: Column) -> Column:
    """``entity_section`` for an unknown entity: no info lines, the name itself
    as the only equivalent name (no array, no lambda)."""
    label = kind.upper()
    return F.concat(
        F.lit(f"**{label}**: "), name, F.lit("\n"),
        F.lit(f"\n**{label} EQUIVALENT NAMES** {EQUIVALENT_NAMES_NOTE}  1. "), name, F.lit("\n"),
    )


def predicate_section(predicate: Column, description: Column) -> Column:
    """F9 part: definition block when a non-empty description exists."""
    return F.when(
        F.coalesce(description, F.lit("")) != "",
        F.concat(
            F.lit("**PREDICATE DEFINITION** ("), display_predicate(predicate), F.lit("):\n"),
            description, F.lit("\n\n"),
        ),
    ).otherwise(F.lit(""))


def answer_budget(est_tokens: Column, model_max_len: int | None) -> Column:
    """4096 when the model length is unknown, else clamp to [512, 4096]."""
    if not model_max_len:
        return F.lit(DEFAULT_MAX_TOKENS).cast("long")
    avail = F.lit(model_max_len) - est_tokens - F.lit(TOKEN_MARGIN)
    return F.greatest(F.lit(MIN_MAX_TOKENS).cast("long"),
                      F.least(F.lit(DEFAULT_MAX_TOKENS).cast("long"), avail.cast("long")))
