"""lamina: a document analytics engine expressed as Spark DataFrame plans."""

import sys

from pyspark import cloudpickle

# functions that run on executors carry their code: executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
