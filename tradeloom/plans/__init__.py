"""The layers of the sales model, composed from the operators."""
