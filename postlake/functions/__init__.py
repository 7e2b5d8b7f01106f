"""Scalar functions as Column -> Column builders."""

from postlake.functions.numeric import is_numeric_null, lenient_int, target_flag, to_class
from postlake.functions.text import (ends_with_question, strip_ws, title_length, whitespace_class, whitespace_chars, word_count)
from postlake.functions.time import (epoch_to_ts, hour_utc, now_utc, partition_date, partition_hour,
                                     weekday_monday0)
from postlake.functions.url import NO_URL, domain, has_url
from postlake.functions.vector import (cosine_distance, cosine_similarity, dimension, dot, from_text,
                                       l2_norm, l2_normalize, quantize, to_text)

__all__ = [
    "is_numeric_null", "lenient_int", "target_flag", "to_class", "ends_with_question", "strip_ws",
    "title_length", "whitespace_class", "whitespace_chars", "word_count", "epoch_to_ts",
    "hour_utc", "now_utc", "partition_date", "partition_hour", "weekday_monday0", "NO_URL", "domain",
    "has_url", "cosine_distance", "cosine_similarity", "dimension", "dot", "from_text", "l2_norm",
    "l2_normalize", "quantize", "to_text",
]
