"""Jobs composed of the operators: cleaning, dimensional modelling, listings and statistics."""
