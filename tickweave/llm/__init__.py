"""Training-data operators: secret scan, quality network, license scan,
repetition rules, SimHash near-dedup, line templates, byte-level BPE, packed
token files, exact dedup and sequence packing.

Every operator is a DataFrame -> DataFrame function with its columns and
limits as parameters.  Nothing outside this package imports it.  Common rules,
unless a docstring says otherwise: a null text counts as empty, a null or
repeated id is allowed, an empty table gives an empty result, and columns that
an operator does not name are ignored (stages of the pipeline keep them).
"""
