"""Steps of a pipeline that prepares text for training language models.

Functions of this package travel with the job that uses them, so executors need its
dependencies (numpy, pyarrow, tokenizers, ...) but not the package itself.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
