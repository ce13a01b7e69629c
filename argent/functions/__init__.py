from argent.functions.columns import (  # noqa: F401
    audit_timestamp,
    complex_text,
    default_or,
    epoch_ms_to_timestamp,
    first_element,
    has_elements,
    last_element,
    last_of,
    non_empty,
    safe_cast,
    surrogate_key,
    tag,
    text_to_integer,
    timestamp_text,
)
