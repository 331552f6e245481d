"""Layer, mart, state and report operators: `f(DataFrame, ...) -> DataFrame`."""
