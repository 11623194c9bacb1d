"""The datasets: silver, gold, BI, questions, serving and conversation jobs."""
