"""JSON helpers for the case metadata document.

One ``json_tuple`` per row extracts all seven fields as text in a single
parse (instead of seven per-path extractions).  Reading text first keeps the
reference's leniency: the number 3, the text "3" and 3.0 all become 3;
``true`` and ``"true"`` both count as true; arrays come back as their
compact JSON text; JSON null, a missing key and malformed text give NULL.
``json_tuple`` returns exactly what ``from_json`` with an all-STRING schema
returns for these fields at about half the per-row cost.
"""

from __future__ import annotations

from casekit.functions.exprs import text_to_int_sql

# Defaults the reference's staging applies to absent fields.
DEFAULT_HANDOFF_COUNT = 0
DEFAULT_COMPLEXITY = "medium"
DEFAULT_MISSING_DOCS = False
DEFAULT_INTAKE_SOURCE = ""
DEFAULT_ARRAY_TEXT = "[]"

# The metadata document's fields.
METADATA_FIELDS = ["intake_source", "barriers", "handoff_count", "complexity",
                   "submitted_documents", "support_flags", "missing_docs"]

def json_fields_sql(text: str, prefix: str) -> str:
    """Generator expression: every metadata field of ``text`` as ``<prefix><field>``."""
    keys = ", ".join(f"'{k}'" for k in METADATA_FIELDS)
    names = ", ".join(f"{prefix}{k}" for k in METADATA_FIELDS)
    return f"json_tuple({text}, {keys}) AS ({names})"


def metadata_columns_sql(prefix: str) -> dict[str, str]:
    """Typed, defaulted staging columns from the text fields ``<prefix><field>``."""
    f = {k: f"{prefix}{k}" for k in METADATA_FIELDS}
    return {
        "handoff_count": f"coalesce({text_to_int_sql(f['handoff_count'])}, {DEFAULT_HANDOFF_COUNT})",
        "complexity": f"trim(coalesce({f['complexity']}, '{DEFAULT_COMPLEXITY}'))",
        "missing_docs": f"coalesce({f['missing_docs']} = 'true', {str(DEFAULT_MISSING_DOCS).lower()})",
        "intake_source": f"trim(coalesce({f['intake_source']}, '{DEFAULT_INTAKE_SOURCE}'))",
        "barriers_json": f"coalesce({f['barriers']}, '{DEFAULT_ARRAY_TEXT}')",
        "support_flags_json": f"coalesce({f['support_flags']}, '{DEFAULT_ARRAY_TEXT}')",
        "submitted_documents_json": f"coalesce({f['submitted_documents']}, '{DEFAULT_ARRAY_TEXT}')",
    }


def json_field_text_sql(text: str, key: str) -> str:
    return f"get_json_object({text}, '$.{key}')"


def text_array_sql(text: str) -> str:
    return f"from_json({text}, 'array<string>')"
