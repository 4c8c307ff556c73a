"""The business questions, each a short composition of operators over a RetailModel."""
