"""Operators for preparing text corpora for model training (one module per operator).

Nothing else in the library imports this subpackage; it imports only general helpers
(``riskspark.session``)."""
