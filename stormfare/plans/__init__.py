"""Models and questions, composed of the operators."""
