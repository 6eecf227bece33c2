"""Operators for preparing language-model training data; nothing else in the library imports them."""

from pyspark import cloudpickle

import touchline

# Workers need not have the package installed.
cloudpickle.register_pickle_by_value(touchline)
