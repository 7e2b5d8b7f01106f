"""Operators of a training-data pipeline, one module each, as Spark jobs.

Shared rules, stated once here and again where an operator adds to them:

* a null text counts as the empty text; a null id sorts after every other id;
* rows that repeat are rows of their own unless a docstring says otherwise;
* an empty table gives an empty result of the stated schema;
* columns an operator adds replace columns of the same name (in any letter
  case) that the input already has; all other columns pass through.
"""
