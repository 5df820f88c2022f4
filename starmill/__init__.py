"""starmill: full-refresh ELT and star-schema modelling as Spark DataFrame plans."""
