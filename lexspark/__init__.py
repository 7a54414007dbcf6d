"""Lexicon building and text-corpus statistics on Spark DataFrames."""
