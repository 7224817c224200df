"""The warehouse itself: silver, conformed, gold and mart definitions, all lazy DataFrames."""
