"""Column-level functions (JVM expressions unless stated otherwise)."""

from semjoin.functions.vectors import (  # noqa: F401
    cosine_distance, cosine_similarity, dot, l2_norm, normalize,
    text_to_vector, vector_dim_ok, vector_to_text,
)
from semjoin.functions.jsonio import parse_json_object, truthy_text, to_json_text  # noqa: F401
from semjoin.functions.text import iso_timestamp, text_preview  # noqa: F401
