"""matchlake: ball-by-ball sports analytics as PySpark DataFrame operators."""
