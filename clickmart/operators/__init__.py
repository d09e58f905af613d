"""Stage, mart, exploration and report operators (DataFrame -> DataFrame)."""
