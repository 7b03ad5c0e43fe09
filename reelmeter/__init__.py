"""reelmeter: clip-quality analytics as Spark jobs.

Clips, sampled frames, detections, model answers and scores are DataFrames.
Operators are ``DataFrame -> DataFrame`` functions whose column names are
parameters; decoders and neural networks are plug-ins that Spark batches.
"""

__version__ = "0.1.0"
