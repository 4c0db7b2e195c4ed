"""Column functions: Java-compatible string split and hash, user functions."""

from eventide.functions.text import lines, split_java, words  # noqa: F401
from eventide.functions.hashing import java_hash  # noqa: F401
from eventide.functions.udfs import register_functions, weighted_avg  # noqa: F401,E402
