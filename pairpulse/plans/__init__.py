"""Date-parameterised jobs over the layers."""
