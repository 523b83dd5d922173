"""granary.functions"""
