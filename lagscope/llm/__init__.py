"""Operations of a training-data pipeline over tables of documents.

Functions that run inside tasks are sent by value, so executors need no copy of this
package. Nothing outside this folder imports it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
