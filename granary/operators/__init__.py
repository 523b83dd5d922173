"""granary.operators"""
