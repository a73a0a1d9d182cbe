"""The two master builds."""
