"""Column-expression building blocks (JVM-side, whole-stage-codegen friendly)."""

from strata.functions.hashing import key_string, row_hash, seed_prefix, uniform
from strata.functions.vectors import (argmax, assemble, cross_entropy, dense_layer,
                                      one_hot, relu)

__all__ = ["key_string", "row_hash", "seed_prefix", "uniform", "argmax", "assemble",
           "cross_entropy", "dense_layer", "one_hot", "relu"]
